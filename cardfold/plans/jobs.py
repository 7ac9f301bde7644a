"""The public jobs: discover, scrape, clean and export, sample for review.

Every job reads a page snapshot instead of the network. ``build_facts`` parses
a snapshot once into a narrow table; store it to run many jobs on it.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardfold import schema
from cardfold.functions.urls import INVALID_URL_MESSAGE, is_public_url, normalize_input_url
from cardfold.operators.crawl import reached_facts
from cardfold.operators.dedupe import deduplicate
from cardfold.operators.enrich import detail_failures, detail_metrics, enrich, enriched_records
from cardfold.operators.extract import categories_from_facts, listing_rows, page_facts
from cardfold.operators.paginate import MISSING_MESSAGE, MISSING_TYPE, paginate
from cardfold.operators.records import (
    clean_records,
    failure_columns,
    split_quarantine,
    union_failures,
)
from cardfold.operators.resolve import parse_requests, resolve_requests
from cardfold.operators.sample import sample_by_category, sample_sheet
from cardfold.operators.summary import (
    categories_table,
    category_metrics as count_categories,
    failures_table,
    run_summary,
    summary_long,
)
from cardfold.session import materialize
from cardfold.sources.delimited import (
    read_master,
    read_rows,
    write_categories_csv,
    write_failures_csv,
    write_master_csv,
    write_sample_csv,
    write_summary_json,
)
from cardfold.sources.snapshot import resolve_attempts, with_snapshot_columns

FETCH_ATTEMPTS = 3
DETAIL_ATTEMPTS = 1  # the concurrent detail lookup does not retry
MASTER, REVIEW = "business_master.csv", "business_master_review"
SUMMARY, FAILURES, CATEGORIES = "run_summary.json", "failed_urls.csv", "trade_categories.csv"

_META = ["url", "attempt", "fetched_at", "status_code", "error_type", "error_message"]


class ScrapeResult(NamedTuple):
    records: DataFrame
    failures: DataFrame
    detail_metrics: DataFrame | None
    category_metrics: DataFrame | None


class PipelineResult(NamedTuple):
    records: DataFrame
    rejected: DataFrame | None
    summary: DataFrame
    output_files: list[str]


def build_facts(
    snapshot: DataFrame,
    selectors: dict[str, str] | None = None,
    detail_selector: str = schema.DETAIL_SELECTOR,
    parts: tuple[str, ...] = ("cards", "categories", "next", "detail"),
) -> DataFrame:
    """One row per fetch attempt with everything the jobs ask of a page."""
    facts = page_facts(
        with_snapshot_columns(snapshot), selectors, detail_selector, parts, keep=_META
    )
    rejected = F.col("error_type").isNull() & F.col("parse_error").isNotNull()
    # Neither a page nor an error is no fetch at all.
    absent = F.col("error_type").isNull() & F.col("absent")
    return (
        facts.withColumn(
            "error_message",
            F.when(rejected, F.col("parse_error"))
            .when(absent, F.lit(MISSING_MESSAGE))
            .otherwise(F.col("error_message")),
        )
        .withColumn(
            "error_type",
            F.when(rejected, F.lit("ParserRejectedMarkup"))
            .when(absent, F.lit(MISSING_TYPE))
            .otherwise(F.col("error_type")),
        )
        .drop("absent", "parse_error")
    )


def _check_url(spark: SparkSession, url: str) -> str:
    """The normalised form of one URL argument."""
    typed = normalize_input_url(F.lit(url))
    row = spark.range(1).select(typed.alias("url"), is_public_url(typed).alias("ok")).first()
    if not row["ok"]:
        raise ValueError(INVALID_URL_MESSAGE)
    return row["url"]


def _page_failure(pages: DataFrame, url: str, now: datetime | None) -> DataFrame:
    """The failure of one wanted page: its error, or its absence."""
    state = pages.where(F.col("url") == url).agg(
        F.count("*").alias("n"), F.first(F.struct(*_META)).alias("page")
    )
    page = F.col("page")
    failed = (F.col("n") == 0) | page["error_type"].isNotNull()
    return state.where(failed).select(
        F.lit(0).cast("long").alias("ord"),
        *failure_columns(
            F.lit(url),
            F.coalesce(page["error_type"], F.lit(MISSING_TYPE)),
            F.when(page["error_type"].isNull(), F.lit(MISSING_MESSAGE)).otherwise(
                F.coalesce(page["error_message"], F.lit(""))
            ),
            page["status_code"],
            F.coalesce(page["fetched_at"], F.lit(now)),
        ),
    )


def discover(
    snapshot: DataFrame,
    url: str,
    output_dir: str | None = None,
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Categories of one directory page and the failure to read it, if any."""
    url = _check_url(snapshot.sparkSession, url)
    wanted = snapshot.where(F.col("url") == url)
    facts = materialize(
        resolve_attempts(build_facts(wanted, parts=("categories",)), FETCH_ATTEMPTS), "facts"
    )
    categories = categories_from_facts(facts.where(F.col("error_type").isNull()))
    failures = _page_failure(facts, url, now)
    if output_dir is not None:
        write_categories_csv(categories, f"{output_dir}/{CATEGORIES}")
        write_failures_csv(failures, f"{output_dir}/{FAILURES}")
    return categories, failures


def scrape_page(
    snapshot: DataFrame,
    url: str,
    limit: int = schema.DEFAULT_PAGE_LIMIT,
    now: datetime | None = None,
) -> ScrapeResult:
    """Listings of one directory page with their detail descriptions.

    Only the page itself and the detail pages it links to are parsed.
    """
    if limit < 1:
        raise ValueError("limit must be greater than 0")
    url = _check_url(snapshot.sparkSession, url)
    facts = materialize(
        resolve_attempts(
            build_facts(snapshot.where(F.col("url") == url), parts=("cards",)), FETCH_ATTEMPTS
        ),
        "facts",
    )
    cards = materialize(
        listing_rows(
            facts.where(F.col("error_type").isNull()), [], F.slice("cards", 1, limit)
        ).withColumn("ord", F.col("card").cast("long")),
        "cards",
    )
    linked = snapshot.join(
        cards.select(F.col("listing_url").alias("url")).distinct(), "url", "left_semi"
    )
    details = resolve_attempts(
        build_facts(linked, parts=("detail",)), FETCH_ATTEMPTS
    )
    outcomes = materialize(enrich(cards.drop("card"), details), "outcomes")
    failures = union_failures(_page_failure(facts, url, now), detail_failures(outcomes))
    return ScrapeResult(enriched_records(outcomes), failures, detail_metrics(outcomes), None)


def scrape_selected_categories(
    snapshot: DataFrame,
    directory_url: str,
    requested: str | list[str] | DataFrame,
    limit_per_category: int = schema.DEFAULT_CATEGORY_LIMIT,
    max_pages_per_category: int = 1,
    detail_concurrency: int = 3,
    selectors: dict[str, str] | None = None,
    site_name: str = "directory",
    now: datetime | None = None,
    facts: DataFrame | None = None,
) -> ScrapeResult:
    """Discover categories, resolve the requested ones, page through them and
    look up every listing's detail page.

    Without ``facts`` the crawl is pruned: the directory page is parsed for its
    categories, then only the category pages that the walks reach (round by
    round, see ``operators.crawl``) and the detail pages their listings link to.
    ``facts`` may pass a stored ``build_facts`` table of the whole snapshot instead.
    """
    if limit_per_category < 1:
        raise ValueError("limit_per_category must be greater than 0")
    if max_pages_per_category < 0:
        raise ValueError("max_pages_per_category cannot be negative")
    if detail_concurrency < 1:
        raise ValueError("detail_concurrency must be at least 1")
    spark = snapshot.sparkSession
    directory_url = _check_url(spark, directory_url)
    if isinstance(requested, DataFrame):
        requests = requested
    else:
        text = requested if isinstance(requested, str) else ",".join(requested)
        requests = parse_requests(spark, text)
    if facts is not None:
        pages = materialize(resolve_attempts(facts.drop("detail_text"), FETCH_ATTEMPTS), "pages")
        directory = pages.where(F.col("url") == directory_url)
    else:
        directory = materialize(
            resolve_attempts(
                build_facts(snapshot.where(F.col("url") == directory_url), selectors, parts=("categories",)),
                FETCH_ATTEMPTS,
            ),
            "directory",
        )
    categories = materialize(categories_from_facts(directory.where(F.col("error_type").isNull())), "categories")
    accepted, unresolved = resolve_requests(
        requests, categories, directory_url, site_name, now=now
    )
    seeds = materialize(accepted, "seeds")
    if facts is None:
        pages = reached_facts(
            snapshot,
            seeds,
            limit_per_category,
            max_pages_per_category,
            lambda rows: build_facts(rows, selectors, parts=("cards", "next")),
            FETCH_ATTEMPTS,
        )
    walked = paginate(seeds, pages, limit_per_category, max_pages_per_category, reached=facts is None)
    listings = materialize(walked.listings.drop("seq", "step", "card"), "listings")
    if facts is not None:
        details = resolve_attempts(facts.select(*_META, "detail_text"), DETAIL_ATTEMPTS)
    else:
        linked = snapshot.join(
            listings.select(F.col("listing_url").alias("url")).distinct(), "url", "left_semi"
        )
        details = resolve_attempts(build_facts(linked, parts=("detail",)), DETAIL_ATTEMPTS)
    outcomes = materialize(enrich(listings, details), "outcomes")
    failures = union_failures(
        _page_failure(directory, directory_url, now),
        unresolved,
        walked.failures,
        detail_failures(outcomes),
    )
    return ScrapeResult(
        enriched_records(outcomes),
        failures,
        detail_metrics(outcomes, detail_concurrency),
        count_categories(categories, requests, walked.visits),
    )


def run_pipeline(
    raw: DataFrame,
    output_dir: str,
    failures: DataFrame | None = None,
    detail_metrics: DataFrame | None = None,
    category_metrics: DataFrame | None = None,
    on_invalid: str = "raise",
    generated_at: datetime | None = None,
) -> PipelineResult:
    """Clean, deduplicate, summarise and export listings (``ord`` + 7 columns).

    ``raise`` stops at the first invalid listing; ``quarantine`` sets invalid
    ones aside and goes on. The categories review table shows what the last
    discovery run wrote to the same folder.
    """
    spark = raw.sparkSession
    cleaned = materialize(clean_records(raw, on_invalid), "cleaned")
    rejected = None
    if on_invalid == "quarantine":
        cleaned, rejected = split_quarantine(cleaned)
    final = materialize(
        deduplicate(cleaned).select(F.col("founder").alias("ord"), *schema.OUTPUT_FIELDS), "final"
    )
    if failures is None:
        failures = spark.createDataFrame([], schema.FAILURE_SCHEMA)
    failures = materialize(failures, "failures")
    names = [MASTER, REVIEW, SUMMARY, FAILURES]
    output_files = [f"{output_dir.rstrip('/')}/{name}" for name in names]
    summary = materialize(
        run_summary(
            cleaned if rejected is None else cleaned.unionByName(rejected.drop("reject_reason")),
            final,
            failures,
            [f"outputs/{name}" for name in names],
            generated_at,
            detail_metrics,
            category_metrics,
            rejected,
        ),
        "summary",
    )
    write_master_csv(final, output_files[0])
    write_review_tables(output_files[1], final, summary, failures, f"{output_dir}/{CATEGORIES}")
    write_summary_json(summary, output_files[2])
    write_failures_csv(failures, output_files[3])
    return PipelineResult(final, rejected, summary, output_files)


def write_review_tables(
    path: str, final: DataFrame, summary: DataFrame | None, failures: DataFrame, categories_path: str
) -> None:
    """The four review sheets as Parquet tables below ``path``."""
    categories = read_rows(final.sparkSession, categories_path, schema.CATEGORY_FIELDS)
    tables = {
        "master": final.orderBy("ord").select(*schema.OUTPUT_FIELDS),
        "summary": summary_long(final, summary).orderBy("section_pos", "item_pos", "key"),
        "failed_urls": failures_table(failures),
        "categories": categories_table(categories),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def create_validation_sample(
    spark, master_path: str, sample_path: str, targets: list[tuple[str, int]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sample a master table per category, write it, report shortages."""
    sample, shortages = sample_by_category(read_master(spark, master_path), targets)
    write_sample_csv(sample_sheet(sample), sample_path)
    return sample, shortages
