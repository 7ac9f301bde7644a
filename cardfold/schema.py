"""Fixed column lists, default selectors and record validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# --- fixed values: output columns, in output order -------------------------
OUTPUT_FIELDS = [
    "business_name",
    "trade_category",
    "region",
    "phone",
    "description",
    "listing_url",
    "source_url",
]
FAILURE_FIELDS = ["url", "error_type", "error_message", "status_code", "timestamp"]
CATEGORY_FIELDS = ["trade_category", "category_url", "listed_count"]

# --- fixed values: default CSS selectors of the directory's page layout -----
CATEGORY_SEGMENT = "business-category"
LISTING_SELECTORS = {
    "listing": "#listings .jet-listing-grid__item[data-post-id]",
    "business_name": "h3.elementor-heading-title a, h3 a",
    "trade_category": "a[href*='/business-category/'].jet-listing-dynamic-terms__link",
    "region": "a[href*='/location/'] .elementor-icon-list-text, a[href*='/location/']",
    "phone": "a[href^='tel:'] .elementor-icon-list-text, a[href^='tel:']",
    "description": ".elementor-widget-theme-post-excerpt p",
    "listing_url": (
        "h3.elementor-heading-title a[href*='/directory/'], "
        "a.elementor-button[href*='/directory/']"
    ),
}
DETAIL_SELECTOR = ".elementor-widget-theme-post-content .elementor-widget-container"
CATEGORY_LINK_SELECTOR = "a[href*='/business-category/']"
CATEGORY_CARD_SELECTOR = (
    ".jet-listing-grid__item "
    ".jet-engine-listing-overlay-wrap[data-url*='/business-category/']"
)
CATEGORY_NAME_SELECTOR = ", ".join(
    f"{heading} a[href*='/business-category/']"
    for heading in ("h1", "h2", "h3", "h4", "h5", "h6", ".elementor-heading-title")
)
CATEGORY_COUNT_SELECTOR = ".jet-listing-dynamic-field__content"
# ---------------------------------------------------------------------------

DEFAULT_PAGE_LIMIT = 20
DEFAULT_CATEGORY_LIMIT = 10

LISTING_SCHEMA = T.StructType(
    [T.StructField("ord", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in OUTPUT_FIELDS]
)
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("trade_category", T.StringType()),
        T.StructField("category_url", T.StringType()),
        T.StructField("listed_count", T.IntegerType()),
    ]
)
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

def check_listing_types(records: DataFrame) -> None:
    """Every listing column must exist and be text; fails at analysis time."""
    types = dict(records.dtypes)
    missing = [name for name in OUTPUT_FIELDS if name not in types]
    if missing:
        raise ValueError(f"missing listing columns: {', '.join(missing)}")
    wrong = [name for name in OUTPUT_FIELDS if types[name] != "string"]
    if wrong:
        raise TypeError(f"listing columns must be text: {', '.join(wrong)}")


def reject_reason(*extra: Column) -> Column:
    """First reason why a row is no valid listing, or null."""
    return F.coalesce(
        *extra,
        F.when(F.col("business_name").isNull(), F.lit("business_name is required")),
        F.when(F.col("source_url").isNull(), F.lit("source_url is required")),
    )


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` with every column computed once, below a barrier.

    A filter above a projection is pushed below it with the projection's
    expressions put in its place, so a check of cleaned fields would run the
    cleaning again inside the filter. Rows that come out of a generator keep
    filters above it: the one-element ``inline`` hands the computed values on.
    """
    fields = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return df.select(F.inline(F.array(fields)))


def validate(records: DataFrame, on_invalid: str = "raise") -> DataFrame:
    """Enforce the listing contract.

    ``raise`` fails the job on the first bad row, ``quarantine`` keeps every row
    and adds ``reject_reason`` (null for good rows).
    """
    check_listing_types(records)
    records = computed_once(records)
    earlier = [F.col("reject_reason")] if "reject_reason" in records.columns else []
    reason = reject_reason(*earlier)
    if on_invalid == "quarantine":
        return records.withColumn("reject_reason", reason)
    if on_invalid != "raise":
        raise ValueError("on_invalid must be 'raise' or 'quarantine'")
    # A filter stays when columns are pruned, so count() and narrow selects check too.
    return records.where(F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean")))


def to_output(records: DataFrame) -> DataFrame:
    """Project to the seven output columns in their fixed order."""
    check_listing_types(records)
    return records.select(*OUTPUT_FIELDS)
