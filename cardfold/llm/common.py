"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; the session's checkpoint folder."""
    from cardfold.session import scratch_path

    return scratch_path(spark, "llm")


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: cuts the lineage."""
    from cardfold.session import materialize

    return materialize(df, label)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Jobs run inside send Python at most ``rows`` rows at once, as ``build_session``
    has it: executors hold such a batch of every task outside their heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for every (start, length), concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def digest(items: Column) -> Column:
    """Lowercase hex SHA-256 of the strings of an array, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small(df: DataFrame, most_rows: int = 2_000_000) -> DataFrame:
    """``df``, a stored table of a few numbers a row, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= most_rows else df


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where an installed public vocabulary file is; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
