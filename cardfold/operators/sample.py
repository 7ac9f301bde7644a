"""First rows per category, for manual checking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardfold.functions.text import category_key
from cardfold.schema import OUTPUT_FIELDS

# Categories of the validation sample and rows wanted of each.
DEFAULT_TARGETS = [("Electricians", 3), ("Plumbers", 3), ("Builders", 4)]
# Columns a reviewer fills in.
STATUS_FIELDS = [
    "business_name_status",
    "phone_status",
    "trade_category_status",
    "region_status",
    "description_status",
    "listing_url_status",
    "source_url_status",
]


def _targets(spark: SparkSession, targets: list[tuple[str, int]]) -> DataFrame:
    rows = [(pos, name, wanted) for pos, (name, wanted) in enumerate(targets)]
    named = spark.createDataFrame(rows, "target_pos int, target string, wanted int")
    return named.withColumn("_key", category_key(F.col("target")))


def _picked(rows: DataFrame, targets: list[tuple[str, int]], ord_col: str) -> DataFrame:
    """The wanted rows of every target. The constant rank bound lets Spark drop
    surplus rows before the shuffle, so a big category costs a few rows a task."""
    wanted = F.broadcast(_targets(rows.sparkSession, targets))  # a literal list
    order = Window.partitionBy("target_pos").orderBy(ord_col)
    most = max(n for _, n in targets)
    return (
        rows.withColumn("_key", category_key(F.col("trade_category")))
        .join(wanted, "_key")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= most)
        .where(F.col("_rank") <= F.col("wanted"))
    )


def sample_by_category(
    rows: DataFrame,
    targets: list[tuple[str, int]] | None = None,
    ord_col: str = "original_csv_row_number",
) -> tuple[DataFrame, DataFrame]:
    """First N rows per target category, and the targets that fell short.

    The sample keeps ``ord_col`` and the listing columns; sort it by
    ``target_pos`` and ``ord_col``.
    """
    targets = targets or DEFAULT_TARGETS
    picked = _picked(rows, targets, ord_col)
    sample = picked.select("target_pos", ord_col, *OUTPUT_FIELDS)
    found = picked.groupBy("target_pos").agg(F.count("*").alias("available"))
    shortages = (
        _targets(rows.sparkSession, targets)
        .join(found, "target_pos", "left")
        .select(
            "target_pos",
            "target",
            "wanted",
            F.coalesce("available", F.lit(0)).alias("available"),
        )
        .where(F.col("available") < F.col("wanted"))
    )
    return sample, shortages


def sample_sheet(sample: DataFrame) -> DataFrame:
    """The sample with empty status and notes columns, everything text."""
    return sample.select(
        "target_pos",
        F.col("original_csv_row_number").alias("ord"),
        F.col("original_csv_row_number").cast("string").alias("original_csv_row_number"),
        *OUTPUT_FIELDS,
        *[F.lit("").alias(name) for name in STATUS_FIELDS],
        F.lit("").alias("notes"),
    )
