"""The page snapshot: what was fetched, or why it was not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardfold.schema import SNAPSHOT_SCHEMA


def with_snapshot_columns(pages: DataFrame) -> DataFrame:
    """Add the snapshot columns a page table lacks: one good attempt per row."""
    defaults = {"attempt": F.lit(1)}
    return pages.select(
        *[
            (F.col(f.name) if f.name in pages.columns else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in SNAPSHOT_SCHEMA.fields
        ]
    )


def page_snapshot(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Scan a snapshot table, or a folder of saved pages (``file_format='html'``,
    where the file path stands for the URL)."""
    if file_format == "html":
        pages = spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("url"), F.col("value").alias("html")
        )
    else:
        pages = spark.read.format(file_format).load(path)
    return with_snapshot_columns(pages)


def succeeded() -> Column:
    """True for an attempt that returned a page."""
    return F.col("error_type").isNull()


def resolve_attempts(
    log: DataFrame, max_attempts: int = 3, url_col: str = "url", ok: Column | None = None
) -> DataFrame:
    """One row per URL: the first success among its first ``max_attempts``
    attempts (numbered from 1), else the last failure among them.

    The first ``max_attempts`` rows of a URL count, whatever their numbers; equal
    numbers go by fetch time, then by a hash of the row. Both rank filters are applied before the shuffle
    too, so a URL with endless attempts sends a few rows per task.
    """
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    ok = succeeded() if ok is None else ok
    times = [name for name in ("fetched_at",) if name in log.columns]
    content = F.xxhash64(*[name for name, kind in log.dtypes if "map<" not in kind])
    tries = Window.partitionBy(url_col).orderBy("attempt", *times, content)
    order = Window.partitionBy(url_col).orderBy(
        ok.desc(), F.when(ok, F.col("_try")).otherwise(-F.col("_try"))
    )
    return (
        log.withColumn("_try", F.row_number().over(tries))
        .where(F.col("_try") <= max_attempts)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_try")
    )
