"""Delimited tables: projected reads, master reads with row numbers, writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cardfold.schema import CATEGORY_FIELDS, FAILURE_FIELDS, OUTPUT_FIELDS
from cardfold.session import materialize

_READ = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**_READ).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def read_rows(spark: SparkSession, path: str, headers: list[str]) -> DataFrame:
    """Keep the named columns, all text; an absent column or null reads as ''.

    A missing path gives no rows.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(h, T.StringType()) for h in headers]))
    rows = _scan(spark, path)
    return rows.select(
        *[
            F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) if h in rows.columns else F.lit("").alias(h)
            for h in headers
        ]
    )


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """Master rows with ``original_csv_row_number`` counted from 2.

    Rows are numbered in file-name order and in record order inside a file, so
    a table written as many part files keeps its order. Each file is numbered by
    the task that reads it; only one row per file is summed over the files.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(f"master CSV does not exist: {path}")
    rows = _scan(spark, path)
    missing = [name for name in OUTPUT_FIELDS if name not in rows.columns]
    if missing:
        raise ValueError("master CSV is missing required columns: " + ", ".join(missing))
    placed = materialize(
        rows.select(
            *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in OUTPUT_FIELDS],
            F.input_file_name().alias("_file"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "master",
    )
    files = placed.groupBy("_file").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    # Part numbers outgrow their padding: part-100000 follows part-99999.
    part = F.regexp_extract("_file", r"part-([0-9]+)[^/]*$", 1)
    part = F.when(part == "", F.lit(None)).otherwise(part).cast("long")
    before = Window.orderBy(part.asc_nulls_first(), "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        "_file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    number = F.col("_before") + F.col("_at") - F.col("_start") + 2
    return placed.join(offsets, "_file").select(
        number.alias("original_csv_row_number"), *OUTPUT_FIELDS
    )


def _write_csv(df: DataFrame, path: str, quote_all: bool) -> None:
    # Records end in LF: with CRLF the writer would also turn every line break
    # inside a value into CRLF.
    (
        df.write.mode("overwrite")
        .options(header=True, quoteAll=quote_all, escape='"', emptyValue='""' if quote_all else "")
        # Values are written as they are, blanks at their edges too.
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as ''."""
    return df.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in df.columns]
    )


def write_master_csv(records: DataFrame, path: str) -> None:
    """All fields quoted, so phones stay text; rows in ``ord`` order if present."""
    ordered = records.orderBy("ord") if "ord" in records.columns else records
    _write_csv(as_text(ordered.select(*OUTPUT_FIELDS)), path, quote_all=True)


def iso_timestamps(failures: DataFrame) -> DataFrame:
    """Failure rows with the timestamp as UTC ISO-8601 text."""
    utc = F.to_utc_timestamp("timestamp", F.current_timezone())
    return failures.withColumn(
        "timestamp", F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def write_failures_csv(failures: DataFrame, path: str) -> None:
    """Header always present, minimal quoting."""
    keys = [name for name in ("stage", "ord") if name in failures.columns]
    ordered = failures.orderBy(*keys) if keys else failures
    _write_csv(as_text(iso_timestamps(ordered).select(*FAILURE_FIELDS)), path, quote_all=False)


def write_categories_csv(categories: DataFrame, path: str) -> None:
    keys = [n for n in ("source_url", "sort_key", "first_at") if n in categories.columns]
    ordered = categories.orderBy(*keys) if keys else categories
    _write_csv(as_text(ordered.select(*CATEGORY_FIELDS)), path, quote_all=True)


def write_sample_csv(sample: DataFrame, path: str) -> None:
    keys = [n for n in ("target_pos", "ord") if n in sample.columns]
    ordered = (sample.orderBy(*keys) if keys else sample).drop(*keys)
    _write_csv(as_text(ordered), path, quote_all=True)


def write_summary_json(summary: DataFrame, path: str) -> None:
    """One indented JSON object with its keys in column order."""
    text = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    summary.select(text.alias("value")).write.mode("overwrite").text(path)
