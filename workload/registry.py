"""The registered queries, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardfold.functions import phone, text, urls
from cardfold.operators import extract, records as rec
from cardfold.operators.dedupe import deduplicate, founders
from cardfold.operators.enrich import detail_failures, detail_metrics, enrich
from cardfold.operators.html import html_nodes
from cardfold.operators.paginate import paginate
from cardfold.operators.resolve import resolve_requests
from cardfold.operators.sample import sample_by_category, sample_sheet
from cardfold.operators.summary import (
    categories_table,
    category_metrics,
    count_by,
    failures_table,
    run_summary,
    summary_long,
)
from cardfold.plans import jobs
from cardfold.schema import CATEGORY_FIELDS, FAILURE_FIELDS, OUTPUT_FIELDS, to_output
from cardfold.session import materialize, scratch_path
from cardfold.sources import delimited
from cardfold.sources.snapshot import page_snapshot, resolve_attempts
from workload import inputs as src
from workload.oracles import LIMITED, UNLIMITED

Query = Callable[[SparkSession, str], DataFrame]
_NAV = src.NAV_SELECTORS
_TARGETS = [("machinery ", 3), (" Building", 5), ("nothing", 2)]
_FAILURE = ["url", "error_type", "error_message", "status_code"]
_DIRECTORY = f"{src.ROOT}/directory/"


# --- functions ----------------------------------------------------------------
def _column(table: str, keys: list[str], name: str, column: Callable[[], F.Column]) -> Query:
    def run(spark, sf_dir):
        rows = src.spread(src.read(spark, sf_dir, table))
        return rows.select(*keys, column().alias(name))

    return run


def _listing_column(name: str, column: Callable[[], F.Column]) -> Query:
    return lambda spark, sf_dir: src.listings(spark, sf_dir).select("ord", column().alias(name))


def decode_tel_parts(spark, sf_dir):
    href = F.concat(F.lit("TEL:+64%20"), F.col("p_partkey"), F.lit("%20%x"))
    return src.read(spark, sf_dir, "part").select("p_partkey", phone.decode_tel(href).alias("phone"))


def listed_count_parts(spark, sf_dir):
    shown = F.concat(F.lit("about ("), F.col("p_partkey"), F.lit(",007) now (1)"))
    odd = F.when(F.col("p_partkey") % 5 == 0, F.lit("none (,)")).otherwise(shown)
    return src.read(spark, sf_dir, "part").select("p_partkey", text.listed_count(odd).alias("listed_count"))


def input_url_pages(spark, sf_dir):
    typed = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" [p]("), "url", F.lit(") ")))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("'"), "url", F.lit("\"")))
        .otherwise(F.concat(F.lit("ftp"), F.expr("substring(url, 5)")))
    )
    normal = urls.normalize_input_url(typed)
    return src.read(spark, sf_dir, "pages").select(
        "page_id", normal.alias("typed_url"), urls.is_public_url(normal).alias("is_public")
    )


def category_key_customers(spark, sf_dir):
    messy = F.concat(F.lit(" \t"), "c_mktsegment", F.lit("\n"))
    keyed = src.read(spark, sf_dir, "customer").groupBy(text.category_key(messy).alias("category_key"))
    return keyed.agg(F.count("*").alias("n"))


def clean_records_listings(spark, sf_dir):
    return rec.clean_records(src.listings(spark, sf_dir))


def quarantine_listings(spark, sf_dir):
    digit = F.col("ord") % 10
    broken = src.listings(spark, sf_dir).withColumns(
        {
            "phone": F.when(digit == 0, F.lit(" 6.4E+10 ")).otherwise(F.col("phone")),
            "business_name": F.when(digit == 1, F.lit("   ")).otherwise(F.col("business_name")),
        }
    )
    return rec.clean_records(broken, "quarantine").select("ord", "reject_reason")


# --- pages ----------------------------------------------------------------------
def page_snapshot_scan(spark, sf_dir):
    pages = page_snapshot(spark, f"{sf_dir}/pages.parquet")
    return pages.select(
        "url", "attempt", "status_code", "error_type", F.length("html").cast("long").alias("n_chars")
    )


def attempts_resolved(spark, sf_dir):
    kept = resolve_attempts(src.attempts(spark, sf_dir), 3)
    return kept.select("url", "attempt", "error_type")


def html_nodes_pages(spark, sf_dir):
    pages = src.web_pages(spark, sf_dir).withColumn("id_url", F.col("page_id").cast("string"))
    nodes = html_nodes(pages, "li, h1, ul, nav, article, a, div", url_col="id_url")
    per_page = nodes.groupBy("tag", "url").agg(F.count("*").alias("n"))
    return per_page.groupBy("tag").agg(F.sum("n").alias("n"), F.count("*").alias("n_pages"))


def selector_texts_pages(spark, sf_dir):
    nodes = html_nodes(src.web_pages(spark, sf_dir), "nav > ul li a[href^='/']")
    return nodes.select(
        "url", F.col("pre").alias("at"), text.clean_display_text(F.col("text")).alias("text"), "href_abs"
    )


def card_count_pages(spark, sf_dir):
    return extract.count_cards(src.web_pages(spark, sf_dir), {"listing": "nav ul li"})


def listings_pages(spark, sf_dir):
    return extract.extract_listings(src.web_pages(spark, sf_dir), 4, _NAV)


def listings_generic_pages(spark, sf_dir):
    return extract.extract_listings_generic(src.web_pages(spark, sf_dir), _NAV)


def detail_pages(spark, sf_dir):
    return extract.extract_detail(src.web_pages(spark, sf_dir), "article h1")


def listings_category_pages(spark, sf_dir):
    return extract.extract_listings(src.category_pages(spark, sf_dir), 20)


def next_page(spark, sf_dir):
    return extract.next_page(src.category_pages(spark, sf_dir))


def discover_categories(spark, sf_dir):
    found = extract.discover_categories(src.directory_pages(spark, sf_dir))
    return found.select("source_url", "trade_category", "category_url", "listed_count")


# --- dataflow -------------------------------------------------------------------
def _category_facts(spark, sf_dir):
    return materialize(
        jobs.build_facts(src.category_pages(spark, sf_dir), parts=("cards", "next")), "facts"
    )


def _paginated(spark, sf_dir, limits):
    return paginate(src.seeds(spark, sf_dir), _category_facts(spark, sf_dir), *limits)


def paginate_visits(spark, sf_dir, limits=LIMITED, columns=("seq", "step", "url", "ok")):
    return _paginated(spark, sf_dir, limits).visits.select(*columns)


def paginate_listings(spark, sf_dir):
    return _paginated(spark, sf_dir, LIMITED).listings.select("seq", "step", "card", *OUTPUT_FIELDS)


def paginate_failures(spark, sf_dir):
    failures = _paginated(spark, sf_dir, UNLIMITED).failures
    return failures.select(F.col("ord").alias("seq"), *_FAILURE)


def _resolved(spark, sf_dir):
    pages = src.main_directory(spark, sf_dir)
    return resolve_requests(
        src.requests(spark, sf_dir), extract.discover_categories(pages), _DIRECTORY
    )


def resolve_accepted(spark, sf_dir):
    return _resolved(spark, sf_dir)[0]


def resolve_failures(spark, sf_dir):
    return _resolved(spark, sf_dir)[1].select(
        F.col("ord").cast("int").alias("pos"), "url", "error_type", "error_message"
    )


def _outcomes(spark, sf_dir, attempts):
    listings = _paginated(spark, sf_dir, LIMITED).listings
    facts = jobs.build_facts(src.detail_pages(spark, sf_dir), parts=("detail",))
    return enrich(listings, resolve_attempts(facts, attempts))


def enrich_details(spark, sf_dir):
    return _outcomes(spark, sf_dir, 3).select("seq", "step", "card", *OUTPUT_FIELDS, "outcome")


def enrich_failures(spark, sf_dir):
    return detail_failures(_outcomes(spark, sf_dir, 3)).select(*_FAILURE)


def enrich_metrics(spark, sf_dir):
    return detail_metrics(_outcomes(spark, sf_dir, 3))


def enrich_concurrent_metrics(spark, sf_dir):
    return detail_metrics(_outcomes(spark, sf_dir, 1), 5)


def category_counts(spark, sf_dir):
    return category_metrics(
        extract.discover_categories(src.main_directory(spark, sf_dir)),
        src.requests(spark, sf_dir),
        _paginated(spark, sf_dir, LIMITED).visits,
    )


def _cleaned(spark, sf_dir):
    return materialize(rec.clean_records(src.listings(spark, sf_dir)), "cleaned")


def _final(spark, sf_dir):
    return deduplicate(_cleaned(spark, sf_dir))


def dedupe_founders(spark, sf_dir):
    return founders(_cleaned(spark, sf_dir))


def dedupe_records(spark, sf_dir):
    return _final(spark, sf_dir).select("founder", "ord", *OUTPUT_FIELDS)


def union_failures(spark, sf_dir):
    walked = _paginated(spark, sf_dir, LIMITED)
    facts = jobs.build_facts(src.detail_pages(spark, sf_dir), parts=("detail",))
    outcomes = enrich(walked.listings, resolve_attempts(facts, 3))
    staged = rec.union_failures(
        _resolved(spark, sf_dir)[1], walked.failures, detail_failures(outcomes)
    )
    return staged.select("stage", *_FAILURE)


def _sampled(spark, sf_dir):
    return sample_by_category(src.listings(spark, sf_dir), _TARGETS, "ord")


def sampled_rows(spark, sf_dir):
    return _sampled(spark, sf_dir)[0]


def sample_shortages(spark, sf_dir):
    return _sampled(spark, sf_dir)[1]


# --- aggregates -----------------------------------------------------------------
def _summarised(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    final = materialize(deduplicate(cleaned), "final")
    return final, run_summary(cleaned, final, _resolved(spark, sf_dir)[1])


_BASE_COUNTS = [
    "total_raw_records",
    "total_records_scraped",
    "duplicates_removed",
    "final_records",
    *[f"missing_{name}" for name in OUTPUT_FIELDS[:5]],
    "failed_urls_count",
]


def summary_row(spark, sf_dir):
    return _summarised(spark, sf_dir)[1].select(*_BASE_COUNTS)


def summary_rows(spark, sf_dir):
    return summary_long(*_summarised(spark, sf_dir))


def counted(spark, sf_dir, field):
    return count_by(_final(spark, sf_dir), field)


# --- sources and sinks ------------------------------------------------------------
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "master-csv")
    delimited.write_master_csv(_cleaned(spark, sf_dir), path)
    return delimited.read_rows(spark, path, OUTPUT_FIELDS)


def read_master(spark, sf_dir):
    path = scratch_path(spark, "master-csv")
    delimited.write_master_csv(_cleaned(spark, sf_dir), path)
    return delimited.read_master(spark, path)


def failures_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "failures-csv")
    delimited.write_failures_csv(_resolved(spark, sf_dir)[1], path)
    return delimited.read_rows(spark, path, FAILURE_FIELDS)


def categories_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "categories-csv")
    found = extract.discover_categories(src.directory_pages(spark, sf_dir))
    delimited.write_categories_csv(found, path)
    return delimited.read_rows(spark, path, CATEGORY_FIELDS)


def summary_json(spark, sf_dir):
    path = scratch_path(spark, "summary-json")
    delimited.write_summary_json(_summarised(spark, sf_dir)[1], path)
    fields = "total_raw_records long, duplicates_removed long, final_records long, missing_region long"
    return spark.read.schema(fields).json(path, multiLine=True)


def review_failures(spark, sf_dir):
    return failures_table(_resolved(spark, sf_dir)[1])


def review_categories_empty(spark, sf_dir):
    found = extract.discover_categories(src.web_pages(spark, sf_dir))
    return categories_table(found)


def sample_sheet_rows(spark, sf_dir):
    sample = sampled_rows(spark, sf_dir).withColumnRenamed("ord", "original_csv_row_number")
    return sample_sheet(sample).drop("target_pos", "ord")


# --- composed jobs ------------------------------------------------------------------
def run_pipeline(spark, sf_dir):
    out = scratch_path(spark, "outputs")
    return jobs.run_pipeline(src.listings(spark, sf_dir), out).records


def _scraped(spark, sf_dir):
    names = src.seeds(spark, sf_dir).select(
        F.col("seq").alias("pos"), urls.category_slug(F.col("url")).alias("item")
    )
    return jobs.scrape_selected_categories(
        src.full_snapshot(spark, sf_dir), _DIRECTORY, names, *LIMITED
    )


def scrape_categories_records(spark, sf_dir):
    return to_output(_scraped(spark, sf_dir).records)


def scrape_categories_failures(spark, sf_dir):
    return _scraped(spark, sf_dir).failures.select(*_FAILURE)


def scrape_page(spark, sf_dir):
    url = f"{src.ROOT}/business-category/economy/"
    return to_output(jobs.scrape_page(src.full_snapshot(spark, sf_dir), url, 8).records)


def discover_job(spark, sf_dir):
    found, _ = jobs.discover(src.full_snapshot(spark, sf_dir), _DIRECTORY)
    return found.select(*CATEGORY_FIELDS)


def validation_sample(spark, sf_dir):
    out = scratch_path(spark, "validation")
    jobs.run_pipeline(src.listings(spark, sf_dir), out)
    sample, _ = jobs.create_validation_sample(
        spark, f"{out}/{jobs.MASTER}", f"{out}/validation_sample.csv", _TARGETS
    )
    return sample


def flagship(spark, sf_dir):
    """Clean listings found on the crawled pages, counted per host."""
    listings = rec.clean_records(
        extract.extract_listings_generic(src.web_pages(spark, sf_dir), _NAV)
    )
    host = F.regexp_extract("listing_url", r"^https?://([^/]+)", 1)
    return (
        listings.groupBy(host.alias("host"), F.lower("business_name").alias("name"))
        .agg(F.count("*").alias("n"))
        .groupBy("host")
        .agg(F.sum("n").alias("listings"), F.count("*").alias("names"))
    )


def queries() -> dict[str, Query]:
    c = F.col
    return {
        "clean_text_documents": _column("documents", ["doc_id"], "cleaned", lambda: text.clean_text(c("text"))),
        "clean_display_documents": _column("documents", ["doc_id"], "cleaned", lambda: text.clean_display_text(c("text"))),
        "clean_display_conversations": _column(
            "conversations", ["conv_id", "turn"], "cleaned", lambda: text.clean_display_text(c("text"))
        ),
        "clean_phone_listings": _listing_column("phone", lambda: phone.clean_phone(c("phone"))),
        "phone_match_key_listings": _listing_column(
            "match_key", lambda: phone.phone_match_key(phone.clean_phone(c("phone")))
        ),
        "decode_tel_parts": decode_tel_parts,
        "clean_url_pages": _column("pages", ["page_id"], "cleaned", lambda: urls.clean_url(c("url"))),
        "category_slug_pages": _column("pages", ["page_id"], "slug", lambda: urls.category_slug(c("url"))),
        "input_url_pages": input_url_pages,
        "category_key_customers": category_key_customers,
        "listed_count_parts": listed_count_parts,
        "completeness_listings": _listing_column(
            "filled", lambda: text.completeness(*[c(name) for name in OUTPUT_FIELDS])
        ),
        "clean_records_listings": clean_records_listings,
        "quarantine_listings": quarantine_listings,
        "project_output_listings": lambda spark, sf_dir: to_output(src.listings(spark, sf_dir)),
        "page_snapshot_scan": page_snapshot_scan,
        "resolve_attempts": attempts_resolved,
        "html_nodes_pages": html_nodes_pages,
        "selector_texts_pages": selector_texts_pages,
        "card_count_pages": card_count_pages,
        "listings_pages": listings_pages,
        "listings_generic_pages": listings_generic_pages,
        "detail_pages": detail_pages,
        "listings_category_pages": listings_category_pages,
        "next_page": next_page,
        "discover_categories": discover_categories,
        "resolve_requests": resolve_accepted,
        "resolve_failures": resolve_failures,
        "paginate_visits": paginate_visits,
        "paginate_listings": paginate_listings,
        "paginate_unlimited": partial(
            paginate_visits, limits=UNLIMITED, columns=("seq", "step", "url", "ok", "take")
        ),
        "paginate_failures": paginate_failures,
        "enrich_details": enrich_details,
        "enrich_failures": enrich_failures,
        "enrich_metrics": enrich_metrics,
        "enrich_concurrent_metrics": enrich_concurrent_metrics,
        "category_metrics": category_counts,
        "dedupe_founders": dedupe_founders,
        "dedupe_records": dedupe_records,
        "union_failures": union_failures,
        "sample_by_category": sampled_rows,
        "sample_shortages": sample_shortages,
        "run_summary": summary_row,
        "count_by_category": partial(counted, field="trade_category"),
        "count_by_region": partial(counted, field="region"),
        "summary_long": summary_rows,
        "csv_roundtrip": csv_roundtrip,
        "read_master": read_master,
        "failures_roundtrip": failures_roundtrip,
        "categories_roundtrip": categories_roundtrip,
        "summary_json": summary_json,
        "review_failures": review_failures,
        "review_categories_empty": review_categories_empty,
        "sample_sheet": sample_sheet_rows,
        "run_pipeline": run_pipeline,
        "scrape_categories_records": scrape_categories_records,
        "scrape_categories_failures": scrape_categories_failures,
        "scrape_page": scrape_page,
        "discover_job": discover_job,
        "validation_sample": validation_sample,
        "flagship": flagship,
    }
