"""Messy directory data derived from the test tables, on Spark.

Each function mirrors a common table expression in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardfold.schema import SNAPSHOT_SCHEMA

ROOT = "https://dir.example"
CARDS_PER_RANGE = 60  # part keys per page range; about ten of them per category
NAV_SELECTORS = {"listing": "nav li", "business_name": "a", "listing_url": "a"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Deal a test table of too few row groups over the cores; others stay as they are.

    The test tables are single row groups, which no split setting divides.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spellings of each firm; some third spellings bridge to another."""
    customer, nation = spread(read(spark, sf_dir, "customer")), read(spark, sf_dir, "nation")
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .selectExpr("*", "c_custkey DIV 3 AS k", "c_custkey % 3 AS v")
        .selectExpr(
            "c_custkey AS ord",
            "CASE v WHEN 0 THEN concat('Firm ', k) WHEN 1 THEN concat('FIRM ', k) "
            "ELSE concat('  Firm \t ', k, ' ') END AS business_name",
            "concat(' ', c_mktsegment) AS trade_category",
            "CASE WHEN v <> 1 THEN n_name END AS region",
            "concat(CASE v WHEN 0 THEN '(09) ' WHEN 1 THEN 'tel:+64 9 ' ELSE '0064 9 ' END, "
            "lpad(k, 7, '0'), CASE WHEN k % 4 = 0 THEN ' ext 7' ELSE '' END) AS phone",
            "CASE v WHEN 0 THEN concat('Work,quality  of ', c_name, ' .') "
            "WHEN 2 THEN concat('See www.firm', k, '.example ,ask') END AS description",
            "CASE WHEN v = 0 THEN concat('https://dir.example/directory/firm-', k) "
            "WHEN v = 1 THEN concat('HTTPS://DIR.Example//directory/firm-', k, '/') "
            "WHEN k % 5 = 4 THEN concat('dir.example/directory/firm-', k - 1) END AS listing_url",
            "concat('https://dir.example/list/', c_nationkey, '/') AS source_url",
        )
    )


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as directory cards: category, page range, card markup."""
    return spread(read(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS k",
        "p_name",
        "p_brand",
        "lower(p_type) AS cat",
        f"p_partkey DIV {CARDS_PER_RANGE} AS b",
        "concat('<div class=\"jet-listing-grid__item\" data-post-id=\"', p_partkey, '\">', "
        "CASE WHEN p_partkey % 7 = 3 THEN '' "
        "WHEN p_partkey % 11 = 5 THEN concat('<h3><a>', p_name, ' ', p_partkey, '</a></h3>') "
        "ELSE concat('<h3 class=\"elementor-heading-title\"><a href=\"/directory/part-', "
        "p_partkey, '/\">', p_name, ' <b>', p_partkey, '</b></a></h3>') END, "
        "'<a href=\"/business-category/x/\" class=\"jet-listing-dynamic-terms__link\">', p_type, '</a>', "
        "'<a href=\"/location/', p_size, '/\"><span class=\"elementor-icon-list-text\">', p_brand, '</span></a>', "
        "CASE WHEN p_partkey % 2 = 0 THEN concat('<a href=\"tel:0800%20', p_partkey, '\"></a>') "
        "ELSE concat('<a href=\"tel:1\">0800 ', p_partkey, '</a>') END, "
        "'<div class=\"elementor-widget-theme-post-excerpt\"><p>Size ', p_size, ' ,made,well</div></div>') AS card",
    )


def category_url(cat: str, b: str) -> str:
    return (
        f"concat('{ROOT}/business-category/', {cat}, "
        f"CASE WHEN {b} = 0 THEN '/' ELSE concat('/page/', {b}, '/') END)"
    )


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of category pages: a page per category and range of part keys,
    linked in order; one category links back to its start, some pages failed."""
    parts = part_rows(spark, sf_dir)
    last = parts.agg(F.max("b").alias("last_b"))
    last_b = last.first()["last_b"]  # one number
    # At most CARDS_PER_RANGE rows meet in a group. The fixed number of partitions
    # keeps AQE from merging pages that are small to move but slow to parse.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cards = parts.repartition(tasks, "cat", "b").groupBy("cat", "b").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "card"))), lambda c: c["card"]), ""
        ).alias("cards")
    )
    failed = "cat = 'small' AND b % 40 = 9"
    after = (
        f"CASE WHEN b < {last_b} THEN {category_url('cat', 'b + 1')} "
        f"WHEN cat = 'promo' THEN {category_url('cat', '0L')} END"
    )
    return cards.selectExpr(
        f"{category_url('cat', 'b')} AS url",
        "1 AS attempt",
        "CAST(NULL AS TIMESTAMP) AS fetched_at",
        f"CASE WHEN {failed} THEN 503 ELSE 200 END AS status_code",
        f"CASE WHEN {failed} THEN 'HTTPError' END AS error_type",
        f"CASE WHEN {failed} THEN 'unavailable' END AS error_message",
        f"CASE WHEN NOT ({failed}) THEN concat('<div id=\"listings\">', cards, '</div>', "
        f"coalesce(concat('<a rel=\"next\" href=\"', {after}, '\">more</a>'), '')) END AS html",
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of detail pages: one per part; failures succeed on retry."""
    parts = spread(read(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS k", "p_brand", "p_size", "explode(sequence(1, IF(p_partkey % 5 = 0, 2, 1))) AS attempt"
    )
    failed = "k % 5 = 0 AND (attempt = 1 OR k % 3 = 0)"
    return parts.selectExpr(
        f"concat('{ROOT}/directory/part-', k, '/') AS url",
        "attempt",
        "CAST(NULL AS TIMESTAMP) AS fetched_at",
        f"CASE WHEN {failed} THEN 504 ELSE 200 END AS status_code",
        f"CASE WHEN {failed} THEN 'Timeout' END AS error_type",
        f"CASE WHEN {failed} THEN concat('slow ', attempt) END AS error_message",
        f"CASE WHEN {failed} THEN NULL WHEN k % 5 = 1 THEN '<p>gone</p>' ELSE concat("
        "'<div class=\"elementor-widget-theme-post-content\"><div class=\"elementor-widget-container\">"
        "<p>All of ', p_brand, '<p>size ', p_size, ',part ', k, ' .</div></div>') END AS html",
    )


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory page per brand: links to its categories, cards for some."""
    counts = (
        read(spark, sf_dir, "part")
        .selectExpr("p_brand", "lower(p_type) AS cat", "p_type")
        .groupBy("p_brand", "cat", "p_type")
        .agg(F.count("*").alias("n"))
    )
    slug = "concat('/business-category/', cat, '/')"
    pieces = counts.selectExpr(
        "p_brand",
        "cat",
        f"concat('<li><a href=\"', {slug}, '\">', cat, '</a></li>') AS link",
        "CASE WHEN n % 2 = 0 THEN concat('<div class=\"jet-listing-grid__item\">"
        f"<div class=\"jet-engine-listing-overlay-wrap\" data-url=\"', {slug}, '\"><h3><a href=\"', {slug}, '\">', "
        "p_type, ' ', p_brand, '</a></h3><i class=\"jet-listing-dynamic-field__content\">(', "
        "n, ',000)</i></div></div>') ELSE '' END AS card",
    )
    joined = pieces.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("cat", "link", "card"))).alias("p"))
    return joined.select(
        F.concat(F.lit(f"{ROOT}/directory/"), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("/")).alias("url"),
        F.concat(
            F.lit("<ul>"),
            F.array_join(F.transform("p", lambda x: x["link"]), ""),
            F.lit("</ul>"),
            F.array_join(F.transform("p", lambda x: x["card"]), ""),
        ).alias("html"),
    )


def main_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory page that links to every category."""
    cats = read(spark, sf_dir, "part").select(F.lower("p_type").alias("cat")).distinct()
    links = cats.agg(F.array_sort(F.collect_set("cat")).alias("cats"))
    return links.select(
        F.lit(f"{ROOT}/directory/").alias("url"),
        F.array_join(
            F.transform(
                "cats",
                lambda c: F.concat(
                    F.lit("<a href='/business-category/"), c, F.lit("/'>"), F.upper(c), F.lit("</a>")
                ),
            ),
            "",
        ).alias("html"),
    )


def as_snapshot(pages: DataFrame) -> DataFrame:
    """Fetched pages ``(url, html)`` as snapshot rows."""
    return pages.select(
        "url",
        F.lit(1).alias("attempt"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
        F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
        "html",
    )


def full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        as_snapshot(main_directory(spark, sf_dir))
        .unionByName(category_pages(spark, sf_dir))
        .unionByName(detail_pages(spark, sf_dir))
        .select(*[f.name for f in SNAPSHOT_SCHEMA.fields])
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every category's first page, numbered by name."""
    cats = read(spark, sf_dir, "part").select(F.lower("p_type").alias("cat")).distinct()
    return cats.select(
        (F.row_number().over(Window.orderBy("cat")) - 1).alias("seq"),
        F.expr(category_url("cat", "0L")).alias("url"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed-in category requests of six kinds, one per supplier."""
    return read(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS INT) AS pos",
        "CASE s_suppkey % 6 WHEN 0 THEN 'promo' WHEN 1 THEN ' ECONOMY/ ' "
        "WHEN 2 THEN concat('nope-', s_suppkey) WHEN 3 THEN concat('a b ', s_suppkey) "
        "WHEN 4 THEN concat('https://x.example/other/', s_suppkey) "
        "ELSE concat('https://x.example/business-category/z', s_suppkey % 7, '/') END AS item",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch log: four numbered attempts per URL, two event kinds are failures."""
    return read(spark, sf_dir, "events").selectExpr(
        f"concat('{ROOT}/e/', event_id DIV 4) AS url",
        "CAST(event_id % 4 + 1 AS INT) AS attempt",
        "CASE WHEN event_type IN ('error', 'click', 'view') THEN event_type END AS error_type",
        "props AS html",
    )


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "pages"))
