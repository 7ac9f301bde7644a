import json
import glob
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cardfold import schema
from cardfold.operators import records as rec
from cardfold.operators.enrich import detail_failures, detail_metrics, enrich, enriched_records
from cardfold.operators.paginate import paginate
from cardfold.operators.resolve import resolve_requests
from cardfold.operators.sample import sample_by_category, sample_sheet
from cardfold.operators.summary import categories_table, count_by, failures_table, run_summary, summary_long
from cardfold.plans import jobs
from cardfold.session import materialize
from cardfold.sources import delimited
from cardfold.sources.snapshot import resolve_attempts, with_snapshot_columns

NOW = datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)
ROOT = "https://dir.example"
DETAIL = (
    '<div class="elementor-widget-theme-post-content">'
    '<div class="elementor-widget-container">{}</div></div>'
)


def listing(ord_, name, **fields):
    row = {**dict.fromkeys(schema.OUTPUT_FIELDS), "business_name": name, "source_url": "https://s", **fields}
    return (ord_, *[row[f] for f in schema.OUTPUT_FIELDS])


def table(spark, *rows):
    return spark.createDataFrame(list(rows), schema.LISTING_SCHEMA)


def snapshot(spark, *rows):
    return spark.createDataFrame(
        [(u, a, NOW, s, e, e and "boom", h) for u, a, s, e, h in rows], schema.SNAPSHOT_SCHEMA
    )


def ok(url, html):
    return (url, 1, 200, None, html)


SHOP_CARD = (
    "<section class='jet-listing-grid__item' data-post-id=shop-{0}>"
    "<a class=jet-listing-dynamic-terms__link href=/business-category/e/>Lamp makers</a>"
    "<h3 class='t elementor-heading-title'><a href='/directory/b{0}/'>Harbour Shop No. {0}</a></h3>"
    "<div class='elementor-widget-theme-post-excerpt x'><p>Short words on {0}</p></div></section>"
)


def category_page(ids, next_url=None):
    link = [f"<link rel='prefetch next' href={next_url}>"] if next_url else []
    return "\n".join([*link, "<main id=listings>", *map(SHOP_CARD.format, ids), "</main>"])


def test_resolve_attempts(spark):
    log = snapshot(
        spark,
        ("a", 1, 500, "E1", None), ("a", 2, 500, "E2", None), ("a", 3, 200, None, "<p>"),
        ("b", 1, 500, "E1", None), ("b", 2, 500, "E2", None), ("b", 3, 500, "E3", None), ("b", 4, 200, None, "x"),
        ("c", 1, 200, None, "1"), ("c", 2, 500, "E2", None),
    )
    got = {r.url: (r.attempt, r.error_type) for r in resolve_attempts(log).collect()}
    assert got == {"a": (3, None), "b": (3, "E3"), "c": (1, None)}
    once = {r.url: r.error_type for r in resolve_attempts(log, 1).collect()}
    assert once == {"a": "E1", "b": "E1", "c": None}


def test_attempts_count_by_rank_and_ties_are_stable(spark):
    log = snapshot(
        spark,
        ("late", 4, 200, None, "x"), ("late", 5, 200, None, "y"),
        *[("zero", n, 500 if n < 3 else 200, "E" if n < 3 else None, "z") for n in range(4)],
        *[("same", 1, 200, None, f"body {n}") for n in range(4)],
    )
    for parts in (1, 5):
        got = {r.url: r for r in resolve_attempts(log.repartition(parts)).collect()}
        assert (got["late"].attempt, got["zero"].attempt, got["zero"].error_type) == (4, 2, "E")
        assert got["same"].html == {r.url: r for r in resolve_attempts(log).collect()}["same"].html


def test_null_page_is_the_same_failure_everywhere(spark):
    shelf = f"{ROOT}/business-category/e/"
    pages = snapshot(
        spark, ok(f"{ROOT}/directory/", "<p>no links</p>"), ok(shelf, category_page([7])),
        ok(f"{ROOT}/directory/b7/", None),
    )
    one = jobs.scrape_page(pages, shelf, now=NOW).failures.collect()
    many = jobs.scrape_selected_categories(pages, f"{ROOT}/directory/", [shelf], now=NOW).failures.collect()
    assert [r.error_type for r in one] == [r.error_type for r in many] == ["NotInSnapshot"]


def test_many_cards_and_far_requests_keep_their_order(spark):
    page = "<div id=listings>" + "".join(map(SHOP_CARD.format, range(20_000))) + "</div>"
    pages = snapshot(spark, ok("u1", page), ok("u2", category_page([1])))
    facts = materialize(jobs.build_facts(pages, parts=("cards", "next")), "facts")
    seeds = spark.createDataFrame([(3, "u1"), (200_000, "u2")], "seq int, url string")
    found = paginate(seeds, facts, 50_000, 1).listings.orderBy("ord").collect()
    assert len(found) == 20_001 and len({r.ord for r in found}) == 20_001
    assert [(r.seq, r.card) for r in found] == [(3, i) for i in range(20_000)] + [(200_000, 0)]


def test_resolve_requests(spark):
    categories = spark.createDataFrame(
        [("Plumbers", f"{ROOT}/business-category/plumbers/", None)], schema.CATEGORY_SCHEMA
    )
    items = ["plumbers", "PLUMBERS/", "nope", "a b", "https://x.nz/other",
             "https://x.nz/business-category/z/", "http:///q"]
    requests = spark.createDataFrame(list(enumerate(items)), "pos int, item string")
    accepted, failures = resolve_requests(requests, categories, f"{ROOT}/directory/")
    assert [tuple(r) for r in accepted.orderBy("seq").collect()] == [
        (0, f"{ROOT}/business-category/plumbers/"),
        (5, "https://x.nz/business-category/z/"),
    ]
    assert [(r.url, r.error_type) for r in failures.orderBy("ord").collect()] == [
        (f"{ROOT}/business-category/nope/", "CategoryNotDiscovered"),
        ("a b", "InvalidCategory"),
        ("https://x.nz/other", "InvalidCategoryURL"),
        ("http:///q", "InvalidCategoryURL"),
    ]


def test_enrich_outcomes(spark):
    rows = table(
        spark,
        listing(1, "A", description="ex", listing_url="u1"),
        listing(2, "B", description="ex", listing_url="u2"),
        listing(3, "C", description="ex", listing_url="u3"),
        listing(4, "D", description="ex"),
        listing(5, "E", description="ex", listing_url=""),
        listing(6, "F", description="ex", listing_url="gone"),
        listing(7, "G", listing_url="u1"),
    )
    details = spark.createDataFrame(
        [("u1", None, None, None, NOW, "full"), ("u2", None, None, None, NOW, None),
         ("u3", "Timeout", "slow", 504, NOW, None)],
        "url string, error_type string, error_message string, status_code int, "
        "fetched_at timestamp, detail_text string",
    )
    out = enrich(rows, details)
    kept = enriched_records(out).orderBy("ord").collect()
    assert [r.description for r in kept] == ["full", "ex", "ex", "ex", "ex", "ex", "full"]
    fails = detail_failures(out).orderBy("ord").collect()
    assert [(r.url, r.error_type, r.status_code) for r in fails] == [
        ("u2", "DescriptionNotFound", None), ("u3", "Timeout", 504),
        ("https://s", "MissingListingURL", None), ("https://s", "MissingListingURL", None),
        ("gone", "NotInSnapshot", None),
    ]
    assert fails[2].error_message == (
        "No listing URL was available for D; the directory-page description was retained."
    )
    assert detail_metrics(out, 2).first().asDict() == {
        "detail_pages_requested": 5, "detail_concurrency": 2, "detail_pages_successful": 2,
        "detail_pages_failed": 5, "descriptions_from_detail_page": 2,
        "descriptions_fallback_to_listing_excerpt": 5,
    }
    with pytest.raises(ValueError):
        detail_metrics(out, 0)


def test_clean_and_validate(spark):
    rows = table(
        spark,
        listing(1, "  A ,b ", phone="tel:09 1", listing_url="X.nz/a/", source_url=" S.nz/ "),
        listing(2, " "),
        listing(3, "B", phone="6.4e+10"),
    )
    flagged = rec.clean_records(rows, "quarantine")
    good, bad = rec.split_quarantine(flagged)
    (row,) = good.collect()
    assert (row.business_name, row.phone, row.listing_url, row.source_url) == (
        "A, b", "09 1", "https://x.nz/a", "https://s.nz")
    assert {r.ord: r.reject_reason for r in bad.collect()} == {
        2: "business_name is required", 3: "phone must not use scientific notation"}
    with pytest.raises(Exception, match="business_name is required"):
        rec.clean_records(rows.where("ord = 2")).collect()
    with pytest.raises(Exception, match="business_name is required"):
        rec.clean_records(rows.where("ord = 2")).select("business_name").collect()
    with pytest.raises(Exception, match="scientific"):
        rec.clean_records(rows.where("ord = 3")).collect()
    # Neither a bare count nor a query of other columns gets around the check.
    for narrow in (lambda r: r, lambda r: r.groupBy("trade_category").count(), lambda r: r.select("region")):
        with pytest.raises(Exception, match="is required|scientific"):
            narrow(rec.clean_records(rows)).count()
    with pytest.raises(TypeError, match="phone"):
        rec.clean_records(rows.withColumn("phone", F.lit(64800555207)))
    with pytest.raises(ValueError, match="region"):
        rec.clean_records(rows.drop("region"))
    assert schema.to_output(rows).columns == schema.OUTPUT_FIELDS


def test_summary(spark):
    raw = table(spark, listing(1, "A"), listing(2, "A"))
    final = table(spark, listing(1, "A"))
    failures = spark.createDataFrame([("u", "T", "m", None, NOW)], schema.FAILURE_SCHEMA)
    detail = spark.range(1).select(F.lit(3).alias("detail_pages_requested"), F.lit(5).alias("detail_concurrency"))
    category = spark.range(1).select(F.lit(64).alias("categories_discovered"))
    row = run_summary(raw, final, failures, ["a", "b"], NOW, detail, category).first()
    assert list(row.asDict()) == [
        "total_raw_records", "total_records_scraped", "duplicates_removed", "final_records",
        "missing_business_name", "missing_trade_category", "missing_region", "missing_phone",
        "missing_description", "failed_urls_count", "output_files", "generated_at",
        "detail_pages_requested", "detail_concurrency", "detail_pages_successful",
        "detail_pages_failed", "descriptions_from_detail_page",
        "descriptions_fallback_to_listing_excerpt", "categories_discovered",
        "categories_requested", "category_pages_scraped",
    ]
    assert list(row)[:10] == [2, 2, 1, 1, 0, 1, 1, 1, 1, 1]
    assert list(row)[10:14] == [["a", "b"], "2026-01-02T03:04:05.678901+00:00", 3, 5]
    assert list(row)[14:] == [0, 0, 0, 0, 64, 0, 0]
    bare = run_summary(raw, final.limit(0), generated_at=NOW).first()
    assert (bare.final_records, bare.duplicates_removed, bare.failed_urls_count, bare.detail_concurrency) == (0, 2, 0, 1)


def test_counts_and_review_tables(spark):
    rows = table(
        spark, listing(1, "A", trade_category="b", region=""), listing(2, "B", trade_category="B"),
        listing(3, "C", trade_category="b"), listing(4, "D"),
    )
    assert [tuple(r) for r in count_by(rows, "trade_category").collect()] == [("B", 1), ("b", 2)]
    assert count_by(rows, "region").collect() == []
    sheet = summary_long(rows, None).orderBy("section_pos", "item_pos", "key").collect()
    assert [(r.key, r.value) for r in sheet] == [
        ("Note", "No scraping_summary.json data was available for this workbook."),
        ("total records", "4"), ("final records", "4"), ("duplicates removed", "0"),
        ("detail descriptions full", ""), ("detail descriptions fallback", ""),
        ("category pages scraped", ""), ("categories requested", ""), ("B", "1"), ("b", "2"),
    ]
    none = failures_table(spark.createDataFrame([], schema.FAILURE_SCHEMA)).collect()
    assert [tuple(r) for r in none] == [("No failed URLs recorded for this sample run.", "", "", "", "")]
    some = failures_table(spark.createDataFrame([("u", "T", "m", 503, NOW)], schema.FAILURE_SCHEMA)).collect()
    assert [tuple(r) for r in some] == [("u", "T", "m", "503", "2026-01-02T03:04:05.678901+00:00")]
    empty = categories_table(spark.createDataFrame([], schema.CATEGORY_SCHEMA)).collect()
    assert [tuple(r) for r in empty] == [("Run discover-categories mode to populate this sheet.", "", "")]


def text_of(path):
    return "".join(open(p, newline="", encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_csv_sinks(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    rows = table(spark, listing(1, 'A "q"\nx', phone="+64 9 555 1111"), listing(2, "B"))
    delimited.write_master_csv(rows.coalesce(1), path)
    text = text_of(path)
    assert text.splitlines()[0] == ",".join(f'"{f}"' for f in schema.OUTPUT_FIELDS)
    assert '"+64 9 555 1111"' in text and '"A ""q""\nx"' in text and text.endswith('"","https://s"\n')
    back = delimited.read_rows(spark, path, ["phone", "business_name", "nope"])
    assert sorted(map(tuple, back.collect())) == [("", "B", ""), ("+64 9 555 1111", 'A "q"\nx', "")]
    assert delimited.read_rows(spark, str(tmp_path / "gone"), ["a"]).collect() == []
    failures = str(tmp_path / "f.csv")
    delimited.write_failures_csv(spark.createDataFrame([], schema.FAILURE_SCHEMA), failures)
    assert text_of(failures) == "url,error_type,error_message,status_code,timestamp\n"
    one = spark.createDataFrame([("https://u", "HTTPError", "a,b", 503, NOW)], schema.FAILURE_SCHEMA)
    delimited.write_failures_csv(one.coalesce(1), failures)
    assert text_of(failures).splitlines()[1] == (
        'https://u,HTTPError,"a,b",503,2026-01-02T03:04:05.678901+00:00')
    categories = str(tmp_path / "c.csv")
    found = spark.createDataFrame([("Electricians", "https://c", 89), ("X", "https://x", None)], schema.CATEGORY_SCHEMA)
    delimited.write_categories_csv(found.coalesce(1), categories)
    assert text_of(categories).splitlines() == [
        '"trade_category","category_url","listed_count"', '"Electricians","https://c","89"', '"X","https://x",""']


def master_file(tmp_path, rows, name="master.csv"):
    head = ",".join(f'"{f}"' for f in schema.OUTPUT_FIELDS)
    lines = [",".join(f'"{v}"' for v in row) for row in rows]
    path = tmp_path / name
    path.write_text("﻿" + "\r\n".join([head, *lines]) + "\r\n", encoding="utf-8")
    return str(path)


def test_validation_sample(spark, tmp_path):
    targets = [("Weavers", 2), ("Bell Founders", 3), ("Cooks", 1)]
    # Every fifth row is a weaver, every fourth other one a bell founder; spellings vary.
    spell = [str.upper, str.title, "  {} ".format, str.lower]
    rows = []
    for i in range(23):
        kind = "weavers" if i % 5 == 2 else "bell founders" if i % 4 == 1 else f"trade {i}"
        rows.append((f"Shop {i}", spell[i % 4](kind), "", "04\n7" if i == 0 else "", "", "", "s"))
    out = str(tmp_path / "sample.csv")
    sample, short = jobs.create_validation_sample(spark, master_file(tmp_path, rows), out, targets)
    got = sample.orderBy("target_pos", "original_csv_row_number").collect()
    assert [r.original_csv_row_number for r in got] == [4, 9, 3, 7, 11]
    assert [(r.target, r.wanted, r.available) for r in short.collect()] == [("Cooks", 1, 0)]
    lines = text_of(out).splitlines()
    assert len(lines) == 6 and lines[1].startswith('"4","Shop 2","') and lines[1].endswith(',""' * 8)
    few = master_file(tmp_path, rows[:4], "few.csv")
    sample, short = sample_by_category(delimited.read_master(spark, few), targets)
    assert sample.count() == 2
    assert [(r.target, r.wanted, r.available) for r in short.orderBy("target_pos").collect()] == [
        ("Weavers", 2, 1), ("Bell Founders", 3, 1), ("Cooks", 1, 0)]
    with pytest.raises(FileNotFoundError):
        delimited.read_master(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bad.csv").write_text("business_name,phone\nA,1\n")
    with pytest.raises(ValueError, match="trade_category, region, description, listing_url, source_url"):
        delimited.read_master(spark, str(tmp_path / "bad.csv"))


def test_master_rows_are_numbered_across_files(spark, tmp_path):
    path = str(tmp_path / "parts.csv")
    rows = table(spark, *[listing(i, f"B{i:03}", phone="1\n2") for i in range(100)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        delimited.write_master_csv(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{path}/part-*")) > 1
    got = delimited.read_master(spark, path).orderBy("original_csv_row_number").collect()
    assert [(r.original_csv_row_number, r.business_name) for r in got] == [
        (i + 2, f"B{i:03}") for i in range(100)]


def test_scrape_selected_categories(spark):
    first, second = f"{ROOT}/business-category/e/", f"{ROOT}/business-category/e/page/2/"
    pages = snapshot(
        spark,
        ok(f"{ROOT}/directory/", '<a href="/business-category/e/">Electricians</a>'),
        (first, 1, 500, "HTTPError", None), (first, 2, 200, None, category_page([1, 2], second)),
        ok(second, category_page([3, 4])),
        ok(f"{ROOT}/directory/b1/", DETAIL.format("Full 1")),
        ok(f"{ROOT}/directory/b2/", "<p>none</p>"),
        (f"{ROOT}/directory/b3/", 1, 504, "Timeout", None),
        (f"{ROOT}/directory/b3/", 2, 200, None, DETAIL.format("never read")),
        (f"{ROOT}/business-category/broken/", 1, None, "Timeout", None),
    )
    wanted = f"e, nope, {ROOT}/business-category/broken/"
    result = jobs.scrape_selected_categories(pages, f"{ROOT}/directory/", wanted, 3, 2, 5, now=NOW)
    rows = result.records.orderBy("ord").collect()
    assert [(r.business_name, r.description, r.source_url) for r in rows] == [
        ("Harbour Shop No. 1", "Full 1", first), ("Harbour Shop No. 2", "Short words on 2", first),
        ("Harbour Shop No. 3", "Short words on 3", second)]
    assert [(r.url, r.error_type) for r in result.failures.orderBy("stage", "ord").collect()] == [
        (f"{ROOT}/business-category/nope/", "CategoryNotDiscovered"),
        (f"{ROOT}/business-category/broken/", "Timeout"),
        (f"{ROOT}/directory/b2/", "DescriptionNotFound"), (f"{ROOT}/directory/b3/", "Timeout")]
    assert result.category_metrics.first().asDict() == {
        "categories_discovered": 1, "categories_requested": 3, "category_pages_scraped": 2}
    assert result.detail_metrics.first().detail_concurrency == 5
    for bad in ({"limit_per_category": 0}, {"max_pages_per_category": -1}, {"detail_concurrency": 0},
                {"requested": " , "}, {"directory_url": "ftp://x"}):
        with pytest.raises(ValueError):
            jobs.scrape_selected_categories(
                **{"snapshot": pages, "directory_url": f"{ROOT}/directory/", "requested": "e", **bad})


def test_failed_directory_page(spark):
    url = f"{ROOT}/business-category/e/"
    pages = snapshot(spark, (f"{ROOT}/directory/", 1, 500, "HTTPError", None), ok(url, category_page([1])))
    result = jobs.scrape_selected_categories(pages, f"{ROOT}/directory/", ["e", url], now=NOW)
    assert [r.error_type for r in result.failures.orderBy("stage", "ord").collect()] == [
        "HTTPError", "CategoryNotDiscovered", "NotInSnapshot"]
    assert result.records.count() == 1


def test_scrape_page(spark):
    url = f"{ROOT}/list/"
    pages = snapshot(
        spark, ok(url, category_page([1, 2, 3])),
        (f"{ROOT}/directory/b1/", 1, 500, "E", None), (f"{ROOT}/directory/b1/", 2, 200, None, DETAIL.format("Full 1")),
    )
    result = jobs.scrape_page(pages, url, limit=2)
    assert [r.description for r in result.records.orderBy("ord").collect()] == ["Full 1", "Short words on 2"]
    assert result.detail_metrics.first().detail_pages_requested == 2
    gone = jobs.scrape_page(pages, f"{ROOT}/gone/", now=NOW)
    assert gone.records.count() == 0
    assert [(r.url, r.error_type) for r in gone.failures.collect()] == [(f"{ROOT}/gone/", "NotInSnapshot")]
    with pytest.raises(ValueError):
        jobs.scrape_page(pages, url, limit=0)


def test_pipeline_writes_every_output(spark, tmp_path):
    out = str(tmp_path / "out")
    pages = snapshot(spark, ok(f"{ROOT}/directory/", '<a href="/business-category/e/">Electricians</a>'))
    categories, failures = jobs.discover(pages, f"{ROOT}/directory/", out)
    assert categories.count() == 1 and failures.count() == 0
    raw = table(
        spark, listing(1, " Pros ", phone="09 555 0123", region="A", trade_category=" T "),
        listing(2, "Pros", phone="+64 9 555 0123", description="d", region="A", trade_category="T"),
        listing(3, "Other", phone="1e5"), listing(4, "Last", region="B"),
    )
    with pytest.raises(Exception, match="scientific"):
        jobs.run_pipeline(raw, out)
    result = jobs.run_pipeline(raw, out, on_invalid="quarantine", generated_at=NOW)
    assert [(r.ord, r.business_name, r.description) for r in result.records.orderBy("ord").collect()] == [
        (1, "Pros", "d"), (4, "Last", None)]
    assert [r.ord for r in result.rejected.collect()] == [3]
    summary = json.loads(text_of(result.output_files[2]))
    assert (summary["total_raw_records"], summary["final_records"], summary["duplicates_removed"]) == (4, 2, 1)
    assert list(summary)[:2] == ["total_raw_records", "total_records_scraped"]
    review = result.output_files[1]
    assert spark.read.parquet(f"{review}/categories").first().trade_category == "Electricians"
    assert spark.read.parquet(f"{review}/failed_urls").count() == 1
    assert spark.read.parquet(f"{review}/master").count() == 2
    assert spark.read.parquet(f"{review}/summary").count() == 7 + 1 + 2
    assert text_of(result.output_files[0]).count("\n") >= 3


def test_pruned_crawl_parses_only_reached_pages(spark):
    first, second, third = (f"{ROOT}/business-category/e/page/{i}/" for i in (1, 2, 3))
    lonely = f"{ROOT}/business-category/lonely/"
    pages = snapshot(
        spark,
        ok(f"{ROOT}/directory/", '<a href="/business-category/e/page/1/">Electricians</a>'
           '<a href="/business-category/lonely/">Lonely</a>'),
        ok(first, category_page([1, 2], second)), ok(second, category_page([3, 4], third)),
        ok(third, category_page([5], first)),  # a cycle back to the first page
        ok(lonely, category_page([9])), ok(f"{ROOT}/unlinked/", category_page([7])),
        ok(f"{ROOT}/directory/b1/", DETAIL.format("Full 1")),
    )
    from cardfold.operators.crawl import reached_facts

    def parse(rows):
        return jobs.build_facts(rows, parts=("cards", "next"))

    # Every row given to the parser comes back as one resolved fact row, so the
    # URLs returned are exactly the URLs parsed.
    seeds = spark.createDataFrame([(0, first)], "seq long, url string")
    got = reached_facts(pages, seeds, 3, 2, parse, 3)
    assert sorted(r.url for r in got.select("url").collect()) == [first, second]
    got = reached_facts(pages, seeds, 100, 0, parse, 3)  # the cycle ends the walk
    assert sorted(r.url for r in got.select("url").collect()) == [first, second, third]
    for limit, max_pages in ((3, 2), (10, 0), (1, 0)):
        pruned = jobs.scrape_selected_categories(pages, f"{ROOT}/directory/", "e", limit, max_pages, now=NOW)
        facts = jobs.build_facts(pages)
        whole = jobs.scrape_selected_categories(pages, f"{ROOT}/directory/", "e", limit, max_pages, now=NOW, facts=facts)
        key = ["ord", "business_name", "source_url", "description"]
        assert pruned.records.select(*key).orderBy("ord").collect() == whole.records.select(*key).orderBy("ord").collect()
        assert pruned.category_metrics.first() == whole.category_metrics.first()
        assert sorted(map(tuple, pruned.failures.drop("failed_at").collect())) == sorted(map(tuple, whole.failures.drop("failed_at").collect()))


def test_validation_filter_reads_cleaned_values_once(spark):
    rows = table(spark, listing(1, "  A  b "), listing(2, "C"))
    checked = rec.clean_records(rows)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)
    bad = table(spark, listing(1, None), listing(2, "C"))
    with pytest.raises(Exception, match="business_name is required"):
        rec.clean_records(bad).count()
    assert rec.clean_records(bad, "quarantine").where(F.col("reject_reason").isNotNull()).count() == 1
