"""Run counts, counts per category and region, and the review tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardfold.schema import CATEGORY_FIELDS, FAILURE_FIELDS
from cardfold.sources.delimited import as_text, iso_timestamps

# Summary keys in output order.
_MISSING = ["business_name", "trade_category", "region", "phone", "description"]
_DETAIL_DEFAULTS = {
    "detail_pages_requested": 0,
    "detail_concurrency": 1,
    "detail_pages_successful": 0,
    "detail_pages_failed": 0,
    "descriptions_from_detail_page": 0,
    "descriptions_fallback_to_listing_excerpt": 0,
}
_CATEGORY_DEFAULTS = {
    "categories_discovered": 0,
    "categories_requested": 0,
    "category_pages_scraped": 0,
}
# Labels of the summary sheet and the summary keys behind them.
_SHEET_METRICS = [
    ("total records", "total_raw_records"),
    ("final records", "final_records"),
    ("duplicates removed", "duplicates_removed"),
    ("detail descriptions full", "descriptions_from_detail_page"),
    ("detail descriptions fallback", "descriptions_fallback_to_listing_excerpt"),
    ("category pages scraped", "category_pages_scraped"),
    ("categories requested", "categories_requested"),
]
_NO_SUMMARY = "No scraping_summary.json data was available for this workbook."
_NO_FAILURES = "No failed URLs recorded for this sample run."
_NO_CATEGORIES = "Run discover-categories mode to populate this sheet."


def _long(counts: DataFrame) -> DataFrame:
    """A one-row table of counts as ``(name, value)`` rows."""
    pairs = [
        F.struct(F.lit(name).alias("name"), F.col(name).cast("long").alias("value"))
        for name in counts.columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def _is_blank(name: str) -> Column:
    return F.coalesce(F.col(name) == "", F.lit(True))


def run_summary(
    raw: DataFrame,
    final: DataFrame,
    failures: DataFrame | None = None,
    output_files: list[str] | tuple[str, ...] = (),
    generated_at: datetime | None = None,
    detail_metrics: DataFrame | None = None,
    category_metrics: DataFrame | None = None,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """The 21 summary values as one row.

    ``rejected`` are the rows of ``raw`` set aside as invalid: no duplicates.

    Every input is reduced to one row of counts first; the rows are then put
    side by side with one more aggregate.
    """
    parts = [
        raw.agg(F.count("*").alias("total_raw_records")),
        final.agg(
            F.count("*").alias("final_records"),
            *[F.count_if(_is_blank(name)).alias(f"missing_{name}") for name in _MISSING],
        ),
    ]
    if failures is not None:
        parts.append(failures.agg(F.count("*").alias("failed_urls_count")))
    if rejected is not None:
        parts.append(rejected.agg(F.count("*").alias("rejected")))
    parts += [m for m in (detail_metrics, category_metrics) if m is not None]
    rows = reduce(DataFrame.unionByName, [_long(part) for part in parts])

    def value(name: str, default: int = 0) -> Column:
        picked = F.max(F.when(F.col("name") == name, F.col("value")))
        return F.coalesce(picked, F.lit(default).cast("long"))

    moment = (generated_at or datetime.now(timezone.utc)).isoformat()
    return rows.agg(
        value("total_raw_records").alias("total_raw_records"),
        value("total_raw_records").alias("total_records_scraped"),
        (value("total_raw_records") - value("rejected") - value("final_records")).alias(
            "duplicates_removed"
        ),
        value("final_records").alias("final_records"),
        *[value(f"missing_{name}").alias(f"missing_{name}") for name in _MISSING],
        value("failed_urls_count").alias("failed_urls_count"),
        F.array(*[F.lit(path) for path in output_files]).cast("array<string>").alias("output_files"),
        F.lit(moment).alias("generated_at"),
        *[
            value(name, default).alias(name)
            for name, default in {**_DETAIL_DEFAULTS, **_CATEGORY_DEFAULTS}.items()
        ],
    )


def count_by(records: DataFrame, field: str) -> DataFrame:
    """Records per value of a field, blanks left out, in code-point order."""
    return (
        records.where(~_is_blank(field))
        .groupBy(field)
        .agg(F.count("*").alias("records"))
        .orderBy(field)
    )


def category_metrics(
    categories: DataFrame, requests: DataFrame, visits: DataFrame
) -> DataFrame:
    """Categories found, items asked for, pages read, as one row."""
    parts = [
        categories.agg(F.count("*").alias("categories_discovered")),
        requests.agg(F.count("*").alias("categories_requested")),
        visits.agg(F.count_if("ok").alias("category_pages_scraped")),
    ]
    rows = reduce(DataFrame.unionByName, [_long(part) for part in parts])
    return rows.agg(
        *[
            F.coalesce(F.max(F.when(F.col("name") == name, F.col("value"))), F.lit(0)).alias(name)
            for name in _CATEGORY_DEFAULTS
        ]
    )


def summary_long(records: DataFrame, summary: DataFrame | None) -> DataFrame:
    """The summary sheet as rows; sort by ``section_pos, item_pos, key``."""

    def item(section: str, section_pos: int, item_pos: int, key: str, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(section_pos).alias("section_pos"),
            F.lit(item_pos).alias("item_pos"),
            F.lit(key).alias("key"),
            value.cast("string").alias("value"),
        )

    if summary is None:
        size = records.agg(F.count("*").alias("n"))
        values = [F.col("n"), F.col("n"), F.lit(0)] + [F.lit("")] * 4
        items = [item("Metric", 0, 0, "Note", F.lit(_NO_SUMMARY))]
        source = size
    else:
        values = [F.col(key) for _, key in _SHEET_METRICS]
        items, source = [], summary
    items += [
        item("Metric", 0, position, label, value)
        for position, ((label, _), value) in enumerate(zip(_SHEET_METRICS, values), start=1)
    ]
    metrics = source.select(F.inline(F.array(*items)))

    def counts(field: str, section_pos: int) -> DataFrame:
        return (
            records.where(~_is_blank(field))
            .groupBy(F.col(field).alias("key"))
            .agg(F.count("*").cast("string").alias("value"))
            .select(
                F.lit(f"Records by {field}").alias("section"),
                F.lit(section_pos).alias("section_pos"),
                F.lit(0).alias("item_pos"),
                "key",
                "value",
            )
        )

    return metrics.unionByName(counts("trade_category", 1)).unionByName(counts("region", 2))


def _or_note(rows: DataFrame, note: str) -> DataFrame:
    """The rows, or one row with a note in its first column if there are none."""
    first, *rest = rows.columns
    empty = rows.limit(1).agg(F.count("*").alias("n")).where(F.col("n") == 0)
    return rows.unionByName(
        empty.select(F.lit(note).alias(first), *[F.lit("").alias(name) for name in rest])
    )


def failures_table(failures: DataFrame) -> DataFrame:
    keys = [name for name in ("stage", "ord") if name in failures.columns]
    ordered = failures.orderBy(*keys) if keys else failures
    return _or_note(as_text(iso_timestamps(ordered).select(*FAILURE_FIELDS)), _NO_FAILURES)


def categories_table(categories: DataFrame) -> DataFrame:
    keys = [n for n in ("source_url", "sort_key", "first_at") if n in categories.columns]
    ordered = categories.orderBy(*keys) if keys else categories
    return _or_note(as_text(ordered.select(*CATEGORY_FIELDS)), _NO_CATEGORIES)
