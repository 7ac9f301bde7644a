"""Cleaning of listing rows, and failure tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardfold.functions.phone import SCIENTIFIC_MESSAGE, clean_phone, is_scientific
from cardfold.functions.text import clean_display_text
from cardfold.functions.urls import clean_url
from cardfold.schema import FAILURE_FIELDS, check_listing_types, validate

_DISPLAY = ["business_name", "trade_category", "region", "description"]


def clean_records(records: DataFrame, on_invalid: str = "raise") -> DataFrame:
    """Clean all seven columns, then enforce the listing contract.

    Other columns pass through. With ``quarantine`` bad rows stay, flagged in
    ``reject_reason``.
    """
    check_listing_types(records)
    cleaned = {name: clean_display_text(F.col(name)) for name in _DISPLAY}
    cleaned["phone"] = clean_phone(
        F.col("phone"), "raise" if on_invalid == "raise" else "null"
    )
    cleaned["listing_url"] = clean_url(F.col("listing_url"))
    cleaned["source_url"] = clean_url(F.col("source_url"))
    if on_invalid == "quarantine":
        cleaned["reject_reason"] = F.when(is_scientific(F.col("phone")), F.lit(SCIENTIFIC_MESSAGE))
    return validate(records.withColumns(cleaned), on_invalid)


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows of a quarantined table."""
    good = flagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, flagged.where(F.col("reject_reason").isNotNull())


def failure_columns(
    url: Column,
    error_type: Column,
    message: Column,
    status: Column | None = None,
    timestamp: Column | None = None,
) -> list[Column]:
    nothing = F.lit(None)
    return [
        url.alias("url"),
        error_type.alias("error_type"),
        message.alias("error_message"),
        (nothing if status is None else status).cast("int").alias("status_code"),
        (nothing if timestamp is None else timestamp).cast("timestamp").alias("timestamp"),
    ]


def union_failures(*tables: DataFrame) -> DataFrame:
    """Failures of consecutive stages; sort by ``stage, ord`` for their order."""
    staged = [
        table.select(
            F.lit(stage).alias("stage"),
            (F.col("ord") if "ord" in table.columns else F.lit(0)).cast("long").alias("ord"),
            *FAILURE_FIELDS,
        )
        for stage, table in enumerate(tables)
    ]
    return reduce(DataFrame.unionByName, staged)
