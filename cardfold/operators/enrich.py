"""Detail descriptions joined to listings, with the outcome of every lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardfold.operators.paginate import MISSING_MESSAGE, MISSING_TYPE
from cardfold.operators.records import failure_columns

# Outcomes, and the failures that keep a listing's excerpt.
FULL, MISSING_URL, ERROR, NOT_FOUND = "full", "missing_url", "error", "not_found"
NOT_FOUND_MESSAGE = (
    "The detail page loaded, but the full description container was not found; "
    "the directory-page excerpt was retained."
)


def enrich(records: DataFrame, details: DataFrame) -> DataFrame:
    """Left join of listings with detail pages on the raw listing URL.

    ``details`` has one row per URL: ``url, detail_text`` and the snapshot's
    error columns. Adds ``outcome`` and, for every outcome but ``full``, the
    ``failure`` struct; ``full`` rows get the page's description.
    """
    has_url = F.coalesce(F.col("listing_url") != "", F.lit(False))
    looked_up = details.select(
        F.col("url").alias("_url"),
        F.struct("error_type", "error_message", "status_code", "fetched_at", "detail_text").alias("_page"),
    )
    # Rows without a link find nothing; a key of their own spreads them out.
    key = F.when(has_url, F.col("listing_url")).otherwise(
        F.concat(F.lit("\x00"), F.col("ord").cast("string"))
    )
    joined = records.withColumn("_url", key).join(looked_up, "_url", "left")
    page = F.col("_page")
    outcome = (
        F.when(~has_url, MISSING_URL)
        .when(page.isNull() | page["error_type"].isNotNull(), ERROR)
        .when(page["detail_text"].isNull(), NOT_FOUND)
        .otherwise(FULL)
    )
    is_missing, is_not_found = F.col("outcome") == MISSING_URL, F.col("outcome") == NOT_FOUND
    message = (
        F.when(
            is_missing,
            F.concat(
                F.lit("No listing URL was available for "),
                F.col("business_name"),
                F.lit("; the directory-page description was retained."),
            ),
        )
        .when(is_not_found, F.lit(NOT_FOUND_MESSAGE))
        .when(page.isNull(), F.lit(MISSING_MESSAGE))
        .otherwise(F.coalesce(page["error_message"], F.lit("")))
    )
    failure = F.struct(
        *failure_columns(
            F.when(is_missing, F.col("source_url")).otherwise(F.col("listing_url")),
            F.when(is_missing, "MissingListingURL")
            .when(is_not_found, "DescriptionNotFound")
            .otherwise(F.coalesce(page["error_type"], F.lit(MISSING_TYPE))),
            message,
            F.when(F.col("outcome") == ERROR, page["status_code"]),
            page["fetched_at"],
        )
    )
    return (
        joined.withColumn("outcome", outcome)
        .withColumn(
            "description",
            F.when(F.col("outcome") == FULL, page["detail_text"]).otherwise(F.col("description")),
        )
        .withColumn("failure", F.when(F.col("outcome") != FULL, failure))
        .drop("_url", "_page")
    )


def enriched_records(outcomes: DataFrame) -> DataFrame:
    return outcomes.drop("outcome", "failure")


def detail_failures(outcomes: DataFrame) -> DataFrame:
    """One failure per listing that kept its excerpt, in listing order."""
    return outcomes.where(F.col("failure").isNotNull()).select("ord", "failure.*")


def detail_metrics(outcomes: DataFrame, concurrency: int | None = None) -> DataFrame:
    """One row of lookup counts; ``detail_concurrency`` is only reported."""
    if concurrency is not None and concurrency < 1:
        raise ValueError("detail concurrency must be at least 1")
    full = F.count_if(F.col("outcome") == FULL)
    fallback = F.count_if(F.col("outcome") != FULL)
    columns = [
        F.count_if(F.col("outcome") != MISSING_URL).alias("detail_pages_requested"),
        full.alias("detail_pages_successful"),
        fallback.alias("detail_pages_failed"),
        full.alias("descriptions_from_detail_page"),
        fallback.alias("descriptions_fallback_to_listing_excerpt"),
    ]
    if concurrency is not None:
        columns.insert(1, F.lit(concurrency).cast("long").alias("detail_concurrency"))
    return outcomes.agg(*columns)
