"""Requested categories to category page URLs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardfold.functions.text import strip
from cardfold.functions.urls import (
    INVALID_URL_MESSAGE,
    category_slug,
    is_public_url,
    normalize_input_url,
    url_origin,
    url_path,
)
from cardfold.operators.records import failure_columns
from cardfold.schema import CATEGORY_SEGMENT


def parse_requests(spark: SparkSession, value: str) -> DataFrame:
    """Comma-separated request text to ``(pos, item)``, blanks dropped."""
    items = strip_items(value)
    if not items:
        raise ValueError("provide at least one category slug or URL")
    return spark.createDataFrame(list(enumerate(items)), "pos int, item string")


def strip_items(value: str) -> list[str]:
    return [item.strip() for item in value.split(",") if item.strip()]


def slug_lookup(categories: DataFrame) -> DataFrame:
    """Category URL per slug; of equal slugs the last in reading order wins."""
    order = [n for n in ("sort_key", "first_at") if n in categories.columns]
    place = F.struct(*order) if order else F.struct(F.lower("trade_category"), "category_url")
    return categories.groupBy(category_slug(F.col("category_url")).alias("slug")).agg(
        F.max_by("category_url", place).alias("found_url")
    )


def resolve_requests(
    requests: DataFrame,
    categories: DataFrame,
    directory_url: str,
    site_name: str = "directory",
    segment: str = CATEGORY_SEGMENT,
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split requests ``(pos, item)`` into accepted ``(seq, url)`` and failures.

    URLs are taken as they are if they point below the category segment; slugs
    must be among the discovered categories. Accepted URLs are distinct and
    keep the place of their first request.
    """
    item = F.col("item")
    slug = F.lower(F.btrim(strip(item), F.lit("/")))
    typed = requests.select(
        "pos",
        "item",
        F.lower(item).rlike(r"\Ahttps?://").alias("is_url"),
        normalize_input_url(item).alias("typed_url"),
        slug.alias("slug"),
    )
    looked_up = typed.join(slug_lookup(categories), "slug", "left")
    is_url, typed_url = F.col("is_url"), F.col("typed_url")
    error_type = (
        F.when(is_url & ~is_public_url(typed_url), "InvalidCategoryURL")
        .when(is_url & ~url_path(typed_url).contains(f"/{segment}/"), "InvalidCategoryURL")
        .when(is_url, None)
        .when(~F.col("slug").rlike(r"\A[a-z0-9-]+\z"), "InvalidCategory")
        .when(F.col("found_url").isNull(), "CategoryNotDiscovered")
    )
    outcome = looked_up.withColumn("error_type", error_type)
    accepted = (
        outcome.where(F.col("error_type").isNull())
        .groupBy(F.when(is_url, typed_url).otherwise(F.col("found_url")).alias("url"))
        .agg(F.min("pos").alias("seq"))
        .select("seq", "url")
    )
    expected = F.concat(
        url_origin(F.lit(directory_url)), F.lit(f"/{segment}/"), F.col("slug"), F.lit("/")
    )
    bad_url = is_url & ~is_public_url(typed_url)
    failed_url = (
        F.when(bad_url, item)
        .when(is_url, typed_url)
        .when(F.col("error_type") == "InvalidCategory", item)
        .otherwise(expected)
    )
    # Failure messages.
    message = (
        F.when(bad_url, F.lit(INVALID_URL_MESSAGE))
        .when(is_url, F.lit(f"The supplied URL is not a {site_name} business category URL."))
        .when(
            F.col("error_type") == "InvalidCategory",
            F.lit(
                f"Category values must be {site_name} category slugs or "
                "public HTTP(S) category URLs."
            ),
        )
        .otherwise(
            F.concat(
                F.lit("The requested category slug '"),
                F.col("slug"),
                F.lit("' was not found on the supplied directory page."),
            )
        )
    )
    failures = outcome.where(F.col("error_type").isNotNull()).select(
        F.col("pos").cast("long").alias("ord"),
        *failure_columns(failed_url, F.col("error_type"), message, timestamp=F.lit(now)),
    )
    return accepted, failures
