"""DuckDB SQL for the registered queries."""

from __future__ import annotations

ROOT = "https://dir.example"
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
TOKEN = r"(?i)https?://[^ ]+|www\.[^ ]+|[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"


# --- scalar expressions ------------------------------------------------------
def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def clean_text(x: str) -> str:
    return f"nullif({collapse(x)}, '')"


def display(x: str) -> str:
    """Punctuation rules on text whose tokens are replaced by a letter and a
    mark; the tokens are put back between the pieces."""
    text = collapse(x)
    masked = f"regexp_replace({text}, '{TOKEN}', 'T' || chr(30), 'g')"
    rules = f"regexp_replace({masked}, ' +([,.;:!?])', '\\1', 'g')"
    for _ in range(2):
        rules = f"regexp_replace({rules}, '([A-Za-z])([,;:!?])([A-Za-z])', '\\1\\2 \\3', 'g')"
    pieces = f"string_split({rules}, 'T' || chr(30))"
    tokens = f"regexp_extract_all({text}, '{TOKEN}')"
    joined = (
        f"list_aggregate(list_transform(list_zip({pieces}, {tokens}), "
        "lambda z: z[1] || coalesce(z[2], '')), 'string_agg', '')"
    )
    return f"nullif(trim({joined}), '')"


def phone(x: str) -> str:
    raw = f"regexp_replace({collapse(x)}, '^(?i:tel:) *', '')"
    raw = f"trim(regexp_replace({raw}, '(?i)(ext|extension|x) *[0-9]+$', ''))"
    return f"CASE WHEN regexp_matches({raw}, '[0-9]') THEN {raw} END"


def phone_key(x: str) -> str:
    digits = f"regexp_replace({phone(x)}, '[^0-9]', '', 'g')"
    return f"nullif(regexp_replace({digits}, '^(0064|64)', '0'), '')"


_PARTS = r"^(?i:(https?))://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def url(x: str) -> str:
    text = f"trim({x})"
    value = f"CASE WHEN regexp_matches({text}, '^(?i:https?://)') THEN {text} ELSE 'https://' || {text} END"

    def part(n: int) -> str:
        return f"regexp_extract({value}, '{_PARTS}', {n})"

    path = f"rtrim(regexp_replace(regexp_replace({part(3)}, ';[^/]*$', ''), '/+', '/', 'g'), '/')"
    whole = (
        f"rtrim(lower({part(1)}) || '://' || lower({part(2)}) || {path} || "
        f"CASE WHEN {part(4)} <> '' THEN '?' || {part(4)} ELSE '' END, '/')"
    )
    return f"CASE WHEN {text} <> '' AND {part(2)} <> '' THEN {whole} END"


def filled(*columns: str) -> str:
    return " + ".join(f"CASE WHEN {clean_text(c)} IS NULL THEN 0 ELSE 1 END" for c in columns)


# --- derived inputs ----------------------------------------------------------
FIELDS = ["business_name", "trade_category", "region", "phone", "description", "listing_url", "source_url"]

LISTINGS = f"""
raw AS (
  SELECT c_custkey AS ord,
    CASE v WHEN 0 THEN 'Firm ' || k WHEN 1 THEN 'FIRM ' || k
      ELSE '  Firm ' || chr(9) || ' ' || k || ' ' END AS business_name,
    ' ' || c_mktsegment AS trade_category,
    CASE WHEN v <> 1 THEN n_name END AS region,
    CASE v WHEN 0 THEN '(09) ' WHEN 1 THEN 'tel:+64 9 ' ELSE '0064 9 ' END
      || lpad(CAST(k AS VARCHAR), 7, '0') || CASE WHEN k % 4 = 0 THEN ' ext 7' ELSE '' END AS phone,
    CASE v WHEN 0 THEN 'Work,quality  of ' || c_name || ' .'
      WHEN 2 THEN 'See www.firm' || k || '.example ,ask' END AS description,
    CASE WHEN v = 0 THEN '{ROOT}/directory/firm-' || k
      WHEN v = 1 THEN 'HTTPS://DIR.Example//directory/firm-' || k || '/'
      WHEN k % 5 = 4 THEN 'dir.example/directory/firm-' || (k - 1) END AS listing_url,
    '{ROOT}/list/' || c_nationkey || '/' AS source_url
  FROM (SELECT *, c_custkey // 3 AS k, c_custkey % 3 AS v FROM customer)
  JOIN nation ON c_nationkey = n_nationkey
)"""

CLEANED = f"""{LISTINGS},
cleaned AS (
  SELECT ord, {display('business_name')} AS business_name, {display('trade_category')} AS trade_category,
    {display('region')} AS region, {phone('phone')} AS phone, {display('description')} AS description,
    {url('listing_url')} AS listing_url, {url('source_url')} AS source_url
  FROM raw
)"""

ALIASES = f"""{CLEANED},
named AS (
  SELECT *, lower({clean_text('business_name')}) AS n, {phone_key('phone')} AS p,
    lower({clean_text('region')}) AS r, {filled(*FIELDS)} AS score
  FROM cleaned
),
alias AS (
  SELECT ord, 0 AS rank, 'u' || listing_url AS a FROM named WHERE listing_url IS NOT NULL
  UNION ALL SELECT ord, 1, 'p' || n || chr(31) || p FROM named WHERE p IS NOT NULL
  UNION ALL SELECT ord, 2, 'r' || n || chr(31) || r FROM named WHERE r IS NOT NULL
  UNION ALL SELECT ord, 3, 's' || n || chr(31) || source_url FROM named
    WHERE listing_url IS NULL AND p IS NULL AND r IS NULL
),
earlier AS (SELECT ord, rank, lag(ord) OVER (PARTITION BY a ORDER BY ord) AS prev FROM alias),
parent AS (
  SELECT ord, arg_min(prev, rank) FILTER (WHERE prev IS NOT NULL) AS up FROM earlier GROUP BY ord
),
tree AS (
  SELECT ord, ord AS founder FROM parent WHERE up IS NULL
  UNION ALL
  SELECT parent.ord, tree.founder FROM parent JOIN tree ON parent.up = tree.ord
),
final AS (
  SELECT t.founder, c.* EXCLUDE (n, p, r, score) FROM (
    SELECT founder, arg_max(ord, CAST(score AS BIGINT) * 1000000000 - ord) AS ord
    FROM tree JOIN named USING (ord) GROUP BY founder
  ) t JOIN named c USING (ord)
)"""


def category_url(cat: str, b: str) -> str:
    return f"('{ROOT}/business-category/' || {cat} || CASE WHEN {b} = 0 THEN '/' ELSE '/page/' || {b} || '/' END)"


PARTS = """
cards AS (
  SELECT lower(p_type) AS cat, p_partkey // 60 AS b, p_partkey AS k, p_partkey % 7 <> 3 AS named,
    p_name || ' ' || p_partkey AS business_name, p_type AS trade_category, p_brand AS region,
    '0800 ' || p_partkey AS phone, 'Size ' || p_size || ',made, well' AS description,
    CASE WHEN p_partkey % 11 <> 5 THEN 'https://dir.example/directory/part-' || p_partkey || '/' END AS listing_url,
    row_number() OVER (PARTITION BY lower(p_type), p_partkey // 60 ORDER BY p_partkey) AS pos
  FROM part
),
last AS (SELECT max(p_partkey) // 60 AS last_b FROM part),
page AS (
  SELECT cat, b, list(named ORDER BY k) AS named, count(*) AS n,
    cat = 'small' AND b % 40 = 9 AS failed,
    CASE WHEN b < last_b THEN b + 1 WHEN cat = 'promo' THEN 0 END AS next_b
  FROM cards, last GROUP BY cat, b, last_b
)"""


def walk(limit: int, max_pages: int) -> str:
    """Pages visited per category, one row per step, with the cards taken."""
    cap = f"AND step + 1 < {max_pages}" if max_pages else ""
    return f"""{PARTS},
seed AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS seq FROM (SELECT DISTINCT cat FROM page)),
walk AS (
  SELECT seq, cat, 0 AS step, CAST(0 AS BIGINT) AS b, [CAST(0 AS BIGINT)] AS seen, CAST({limit} AS BIGINT) AS rem FROM seed
  UNION ALL
  SELECT seq, cat, step + 1, next_b, list_append(seen, next_b), rem - got FROM (
    SELECT walk.*, page.next_b, len(list_filter(named[1:rem], lambda x: x)) AS got
    FROM walk JOIN page USING (cat, b)
    WHERE NOT failed {cap}
  ) WHERE next_b IS NOT NULL AND NOT list_contains(seen, next_b) AND rem - got > 0
),
visit AS (
  SELECT seq, cat, step, b, {category_url('cat', 'b')} AS url, NOT coalesce(failed, true) AS ok, failed,
    CASE WHEN NOT failed THEN least(rem, n) ELSE 0 END AS take
  FROM walk LEFT JOIN page USING (cat, b)
),
listing AS (
  SELECT seq, step, CAST(pos - 1 AS INTEGER) AS card, cards.* EXCLUDE (cat, b, k, named, pos), url AS source_url, k
  FROM visit JOIN cards USING (cat, b) WHERE ok AND pos <= take AND named
)"""


def enriched(attempts: int, limit: int, max_pages: int) -> str:
    error = f"(k % 5 = 0 AND ({attempts} = 1 OR k % 3 = 0))"
    return f"""{walk(limit, max_pages)},
outcome AS (
  SELECT *, CASE WHEN listing_url IS NULL THEN 'missing_url' WHEN {error} THEN 'error'
    WHEN k % 5 = 1 THEN 'not_found' ELSE 'full' END AS outcome
  FROM (SELECT listing.*, p_brand, p_size FROM listing JOIN part ON p_partkey = k)
),
detail AS (
  SELECT * REPLACE (CASE WHEN outcome = 'full' THEN 'All of ' || p_brand || ' size ' || p_size || ',part ' || k || '.'
    ELSE description END AS description) FROM outcome
),
detail_failure AS (
  SELECT seq, step, card,
    CASE WHEN outcome = 'missing_url' THEN source_url ELSE listing_url END AS url,
    CASE outcome WHEN 'missing_url' THEN 'MissingListingURL' WHEN 'not_found' THEN 'DescriptionNotFound'
      ELSE 'Timeout' END AS error_type,
    CASE outcome WHEN 'missing_url' THEN 'No listing URL was available for ' || business_name
        || '; the directory-page description was retained.'
      WHEN 'not_found' THEN 'The detail page loaded, but the full description container was not found; '
        || 'the directory-page excerpt was retained.'
      ELSE 'slow {attempts if attempts < 2 else 2}' END AS error_message,
    CASE WHEN outcome = 'error' THEN 504 END AS status_code
  FROM outcome WHERE outcome <> 'full'
),
page_failure AS (
  SELECT seq, url, CASE WHEN failed THEN 'HTTPError' ELSE 'NotInSnapshot' END AS error_type,
    CASE WHEN failed THEN 'unavailable' ELSE 'The page is not part of the snapshot.' END AS error_message,
    CASE WHEN failed THEN 503 END AS status_code
  FROM visit WHERE NOT ok
)"""


REQUESTS = """
request AS (
  SELECT CAST(s_suppkey AS INTEGER) AS pos, s_suppkey % 6 AS kind, s_suppkey AS k,
    CASE s_suppkey % 6 WHEN 0 THEN 'promo' WHEN 1 THEN ' ECONOMY/ '
      WHEN 2 THEN 'nope-' || s_suppkey WHEN 3 THEN 'a b ' || s_suppkey
      WHEN 4 THEN 'https://x.example/other/' || s_suppkey
      ELSE 'https://x.example/business-category/z' || s_suppkey % 7 || '/' END AS item
  FROM supplier
)"""

_SEPARATE = "'https://dir.example/business-category/'"

DIRECTORY = """
pair AS (
  SELECT replace(p_brand, '#', '-') AS brand, p_brand, lower(p_type) AS cat, p_type, count(*) AS n
  FROM part GROUP BY ALL
)"""

# --- HTML of the given pages --------------------------------------------------
_HOST = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"


def unescape(x: str) -> str:
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{character}')"
    return x


NAV = f"""
item AS (
  SELECT url, unnest(list_zip(
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1),
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2),
    range(len(regexp_extract_all(html, '<li><a '))))) AS z
  FROM pages
),
nav AS (
  SELECT url, CAST(z[3] AS INTEGER) AS card, {display(unescape('z[2]'))} AS business_name,
    CASE WHEN z[1] <> '' THEN {_HOST} || {unescape('z[1]')} END AS listing_url
  FROM item
)"""

_NAV_COLUMNS = (
    "card, business_name, CAST(NULL AS VARCHAR) AS trade_category, CAST(NULL AS VARCHAR) AS region, "
    "CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS description, listing_url, url AS source_url"
)

_COUNTS = (
    "CAST(count(*) FILTER (WHERE outcome <> 'missing_url') AS BIGINT) AS detail_pages_requested, {extra}"
    "CAST(count(*) FILTER (WHERE outcome = 'full') AS BIGINT) AS detail_pages_successful, "
    "CAST(count(*) FILTER (WHERE outcome <> 'full') AS BIGINT) AS detail_pages_failed, "
    "CAST(count(*) FILTER (WHERE outcome = 'full') AS BIGINT) AS descriptions_from_detail_page, "
    "CAST(count(*) FILTER (WHERE outcome <> 'full') AS BIGINT) AS descriptions_fallback_to_listing_excerpt"
)


def _blank(column: str) -> str:
    return f"CAST(count(*) FILTER (WHERE coalesce({column}, '') = '') AS BIGINT) AS missing_{column}"


SUMMARY = f"""
summary AS (
  SELECT total_raw_records, total_raw_records AS total_records_scraped,
    total_raw_records - final_records AS duplicates_removed, final_records,
    missing_business_name, missing_trade_category, missing_region, missing_phone, missing_description,
    failed_urls_count
  FROM (SELECT count(*) AS total_raw_records FROM cleaned),
    (SELECT count(*) AS final_records, {', '.join(map(_blank, FIELDS[:5]))} FROM final),
    (SELECT count(*) AS failed_urls_count FROM supplier WHERE s_suppkey % 6 IN (2, 3, 4))
)"""

TARGETS = "(VALUES (0, 'machinery ', 3), (1, ' Building', 5), (2, 'nothing', 2))"
SAMPLE = f"""
target AS (SELECT pos, lower({collapse('name')}) AS key, name, n FROM {TARGETS} t(pos, name, n)),
picked AS (
  SELECT pos, ord, n, row_number() OVER (PARTITION BY pos ORDER BY ord) AS rn
  FROM raw JOIN target ON lower({collapse('trade_category')}) = key
  QUALIFY rn <= n
)"""

_OUT = ", ".join(FIELDS)
_TEXT_OUT = ", ".join(f"coalesce({f}, '') AS {f}" for f in FIELDS)

LIMITED = (25, 5)
UNLIMITED = (1_000_000_000, 0)


def oracle_sql() -> dict[str, str]:
    detail_3, detail_1 = enriched(3, *LIMITED), enriched(1, *LIMITED)
    request_failure = f"""
request_failure AS (
  SELECT pos, CASE kind WHEN 2 THEN {_SEPARATE} || 'nope-' || k || '/' ELSE item END AS url,
    CASE kind WHEN 2 THEN 'CategoryNotDiscovered' WHEN 3 THEN 'InvalidCategory' ELSE 'InvalidCategoryURL' END AS error_type,
    CASE kind WHEN 2 THEN 'The requested category slug ''nope-' || k || ''' was not found on the supplied directory page.'
      WHEN 3 THEN 'Category values must be directory category slugs or public HTTP(S) category URLs.'
      ELSE 'The supplied URL is not a directory business category URL.' END AS error_message
  FROM request WHERE kind IN (2, 3, 4)
)"""
    accepted = f"""
accepted AS (
  SELECT min(pos) AS seq, CASE kind WHEN 0 THEN {_SEPARATE} || 'promo/' WHEN 1 THEN {_SEPARATE} || 'economy/'
    ELSE item END AS url
  FROM request WHERE kind IN (0, 1, 5) GROUP BY 2
)"""
    return {
        # functions
        "clean_text_documents": f"SELECT doc_id, {clean_text('text')} AS cleaned FROM documents",
        "clean_display_documents": f"SELECT doc_id, {display('text')} AS cleaned FROM documents",
        "clean_display_conversations": (
            f"SELECT conv_id, turn, {display('text')} AS cleaned FROM conversations"
        ),
        "clean_phone_listings": f"WITH {LISTINGS} SELECT ord, {phone('phone')} AS phone FROM raw",
        "phone_match_key_listings": f"WITH {LISTINGS} SELECT ord, {phone_key(phone('phone'))} AS match_key FROM raw",
        "decode_tel_parts": "SELECT p_partkey, '+64 ' || p_partkey || ' %x' AS phone FROM part",
        "clean_url_pages": f"SELECT page_id, {url('url')} AS cleaned FROM pages",
        "category_slug_pages": (
            "SELECT page_id, lower(regexp_extract(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), "
            "'([^/]*)/*$', 1)) AS slug FROM pages"
        ),
        "input_url_pages": (
            "SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 'ftp' || substr(url, 5) ELSE url END AS typed_url, "
            "page_id % 3 <> 2 AS is_public FROM pages"
        ),
        "category_key_customers": (
            "SELECT lower(c_mktsegment) AS category_key, count(*) AS n FROM customer GROUP BY 1"
        ),
        "listed_count_parts": (
            "SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN CAST(p_partkey * 1000 + 7 AS INTEGER) END AS listed_count FROM part"
        ),
        "completeness_listings": f"WITH {LISTINGS} SELECT ord, {filled(*FIELDS)} AS filled FROM raw",
        "clean_records_listings": f"WITH {CLEANED} SELECT * FROM cleaned",
        "quarantine_listings": (
            f"WITH {LISTINGS} SELECT ord, CASE WHEN ord % 10 = 0 THEN 'phone must not use scientific notation' "
            "WHEN ord % 10 = 1 THEN 'business_name is required' END AS reject_reason FROM raw"
        ),
        "project_output_listings": f"WITH {LISTINGS} SELECT {_OUT} FROM raw",
        # pages
        "page_snapshot_scan": (
            "SELECT url, 1 AS attempt, CAST(NULL AS INTEGER) AS status_code, CAST(NULL AS VARCHAR) AS error_type, "
            "CAST(length(html) AS BIGINT) AS n_chars FROM pages"
        ),
        "resolve_attempts": (
            f"SELECT '{ROOT}/e/' || g AS url, attempt, error_type FROM ("
            "SELECT event_id // 4 AS g, CAST(event_id % 4 + 1 AS INTEGER) AS attempt, "
            "CASE WHEN event_type IN ('error', 'click', 'view') THEN event_type END AS error_type FROM events "
            "WHERE event_id % 4 < 3 QUALIFY row_number() OVER (PARTITION BY event_id // 4 ORDER BY "
            "error_type IS NULL DESC, CASE WHEN error_type IS NULL THEN event_id ELSE -event_id END) = 1)"
        ),
        "html_nodes_pages": (
            "SELECT tag, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM (SELECT page_id, "
            "unnest(regexp_extract_all(html, '<(li|h1|ul|nav|article|a|div)[ >]', 1)) AS tag FROM pages) GROUP BY tag"
        ),
        "selector_texts_pages": (
            f"WITH {NAV} SELECT url, card AS at, business_name AS text, listing_url AS href_abs FROM nav "
            "WHERE listing_url IS NOT NULL"
        ),
        "card_count_pages": (
            "SELECT url, CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS n_cards FROM pages"
        ),
        "listings_pages": f"WITH {NAV} SELECT {_NAV_COLUMNS} FROM nav WHERE card < 4 AND business_name IS NOT NULL",
        "listings_generic_pages": f"WITH {NAV} SELECT {_NAV_COLUMNS} FROM nav WHERE business_name IS NOT NULL",
        "detail_pages": (
            f"SELECT url, {display(unescape(_first_heading()))} AS description FROM pages"
        ),
        "listings_category_pages": (
            f"WITH {PARTS} SELECT CAST(pos - 1 AS INTEGER) AS card, business_name, trade_category, region, phone, description, "
            f"listing_url, {category_url('cat', 'b')} AS source_url FROM cards JOIN page USING (cat, b) "
            "WHERE cards.named AND NOT failed AND pos <= 20"
        ),
        "next_page": (
            f"WITH {PARTS} SELECT {category_url('cat', 'b')} AS url, "
            f"CASE WHEN next_b IS NOT NULL AND NOT failed THEN {category_url('cat', 'next_b')} END AS next_url FROM page"
        ),
        "discover_categories": (
            f"WITH {DIRECTORY} SELECT '{ROOT}/directory/' || brand || '/' AS source_url, "
            "CASE WHEN n % 2 = 0 THEN p_type || ' ' || p_brand ELSE cat END AS trade_category, "
            f"{_SEPARATE} || cat || '/' AS category_url, "
            "CASE WHEN n % 2 = 0 THEN CAST(n * 1000 AS INTEGER) END AS listed_count FROM pair"
        ),
        # dataflow
        "resolve_requests": f"WITH {REQUESTS},{accepted} SELECT seq, url FROM accepted",
        "resolve_failures": f"WITH {REQUESTS},{request_failure} SELECT pos, url, error_type, error_message FROM request_failure",
        "paginate_visits": f"WITH RECURSIVE {walk(*LIMITED)} SELECT seq, step, url, ok FROM visit",
        "paginate_listings": (
            f"WITH RECURSIVE {walk(*LIMITED)} SELECT seq, step, card, {_OUT} FROM listing"
        ),
        "paginate_unlimited": f"WITH RECURSIVE {walk(*UNLIMITED)} SELECT seq, step, url, ok, CAST(take AS INTEGER) AS take FROM visit",
        "paginate_failures": f"WITH RECURSIVE {enriched(3, *UNLIMITED)} SELECT CAST(seq AS BIGINT) AS seq, url, error_type, error_message, status_code FROM page_failure",
        "enrich_details": f"WITH RECURSIVE {detail_3} SELECT seq, step, card, {_OUT}, outcome FROM detail",
        "enrich_failures": f"WITH RECURSIVE {detail_3} SELECT url, error_type, error_message, status_code FROM detail_failure",
        "enrich_metrics": f"WITH RECURSIVE {detail_3} SELECT {_COUNTS.format(extra='')} FROM outcome",
        "enrich_concurrent_metrics": (
            f"WITH RECURSIVE {detail_1} SELECT {_COUNTS.format(extra='CAST(5 AS BIGINT) AS detail_concurrency, ')} FROM outcome"
        ),
        "category_metrics": (
            f"WITH RECURSIVE {walk(*LIMITED)} SELECT (SELECT count(DISTINCT p_type) FROM part) AS categories_discovered, "
            "(SELECT count(*) FROM supplier) AS categories_requested, count(*) FILTER (WHERE ok) AS category_pages_scraped FROM visit"
        ),
        "dedupe_founders": f"WITH RECURSIVE {ALIASES} SELECT ord FROM parent WHERE up IS NULL",
        "dedupe_records": f"WITH RECURSIVE {ALIASES} SELECT founder, ord, {_OUT} FROM final",
        "union_failures": (
            f"WITH RECURSIVE {detail_3},{REQUESTS},{request_failure} "
            "SELECT 0 AS stage, url, error_type, error_message, CAST(NULL AS INTEGER) AS status_code FROM request_failure "
            "UNION ALL SELECT 1, url, error_type, error_message, status_code FROM page_failure "
            "UNION ALL SELECT 2, url, error_type, error_message, status_code FROM detail_failure"
        ),
        "sample_by_category": (
            f"WITH {LISTINGS},{SAMPLE} SELECT picked.pos AS target_pos, ord, {_OUT} FROM picked JOIN raw USING (ord)"
        ),
        "sample_shortages": (
            f"WITH {LISTINGS},{SAMPLE} SELECT pos AS target_pos, name AS target, n AS wanted, "
            "count(ord) AS available FROM target LEFT JOIN picked USING (pos, n) GROUP BY ALL HAVING count(ord) < n"
        ),
        # aggregates
        "run_summary": f"WITH RECURSIVE {ALIASES},{SUMMARY} SELECT * FROM summary",
        "count_by_category": f"WITH RECURSIVE {ALIASES} SELECT trade_category, count(*) AS records FROM final GROUP BY 1",
        "count_by_region": (
            f"WITH RECURSIVE {ALIASES} SELECT region, count(*) AS records FROM final WHERE coalesce(region, '') <> '' GROUP BY 1"
        ),
        "summary_long": _summary_long(),
        # sources and sinks
        "csv_roundtrip": f"WITH {CLEANED} SELECT {_TEXT_OUT} FROM cleaned",
        "read_master": (
            f"WITH {CLEANED} SELECT row_number() OVER (ORDER BY ord) + 1 AS original_csv_row_number, {_TEXT_OUT} FROM cleaned"
        ),
        "failures_roundtrip": (
            f"WITH {REQUESTS},{request_failure} SELECT url, error_type, error_message, '' AS status_code, '' AS \"timestamp\" FROM request_failure"
        ),
        "categories_roundtrip": (
            f"WITH {DIRECTORY} SELECT CASE WHEN n % 2 = 0 THEN p_type || ' ' || p_brand ELSE cat END AS trade_category, "
            f"{_SEPARATE} || cat || '/' AS category_url, CASE WHEN n % 2 = 0 THEN CAST(n * 1000 AS VARCHAR) ELSE '' END AS listed_count FROM pair"
        ),
        "summary_json": f"WITH RECURSIVE {ALIASES},{SUMMARY} SELECT total_raw_records, duplicates_removed, final_records, missing_region FROM summary",
        "review_failures": (
            f"WITH {REQUESTS},{request_failure} SELECT url, error_type, error_message, '' AS status_code, '' AS \"timestamp\" FROM request_failure"
        ),
        "review_categories_empty": (
            "SELECT 'Run discover-categories mode to populate this sheet.' AS trade_category, '' AS category_url, '' AS listed_count"
        ),
        "sample_sheet": (
            f"WITH {LISTINGS},{SAMPLE} SELECT CAST(ord AS VARCHAR) AS original_csv_row_number, {_OUT}, "
            + ", ".join(f"'' AS {f}_status" for f in FIELDS)
            + ", '' AS notes FROM picked JOIN raw USING (ord)"
        ),
        # composed jobs
        "run_pipeline": f"WITH RECURSIVE {ALIASES} SELECT founder AS ord, {_OUT} FROM final",
        "scrape_categories_records": _scrape(f"SELECT {_OUT} FROM detail"),
        "scrape_categories_failures": _scrape(
            "SELECT url, error_type, error_message, status_code FROM page_failure "
            "UNION ALL SELECT url, error_type, error_message, status_code FROM detail_failure"
        ),
        "scrape_page": (
            f"WITH RECURSIVE {enriched(3, 8, 1)} SELECT {_OUT} FROM detail WHERE source_url = '{ROOT}/business-category/economy/'"
        ),
        "discover_job": (
            f"SELECT DISTINCT p_type AS trade_category, {_SEPARATE} || lower(p_type) || '/' AS category_url, "
            "CAST(NULL AS INTEGER) AS listed_count FROM part"
        ),
        "validation_sample": _validation(),
        "flagship": _flagship(),
    }


def _first_heading() -> str:
    return r"regexp_extract(html, '<h1>([^<]*)</h1>', 1)"


def _scrape(select: str) -> str:
    return f"WITH RECURSIVE {enriched(1, *LIMITED)} {select}"


def _summary_long() -> str:
    metrics = [
        ("total records", "total_raw_records"),
        ("final records", "final_records"),
        ("duplicates removed", "duplicates_removed"),
        ("detail descriptions full", "0"),
        ("detail descriptions fallback", "0"),
        ("category pages scraped", "0"),
        ("categories requested", "0"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT 'Metric' AS section, 0 AS section_pos, {i} AS item_pos, '{label}' AS key, CAST({column} AS VARCHAR) AS value FROM summary"
        for i, (label, column) in enumerate(metrics, start=1)
    )
    counts = " UNION ALL ".join(
        f"SELECT 'Records by {field}', {i}, 0, {field}, CAST(count(*) AS VARCHAR) FROM final WHERE coalesce({field}, '') <> '' GROUP BY {field}"
        for i, field in ((1, "trade_category"), (2, "region"))
    )
    return f"WITH RECURSIVE {ALIASES},{SUMMARY} {rows} UNION ALL {counts}"


def _validation() -> str:
    return f"""WITH RECURSIVE {ALIASES},
numbered AS (SELECT row_number() OVER (ORDER BY founder) + 1 AS nr, * FROM final),
target AS (SELECT pos, lower({collapse('name')}) AS key, n FROM {TARGETS} t(pos, name, n))
SELECT pos AS target_pos, nr AS original_csv_row_number, {_TEXT_OUT} FROM numbered
JOIN target ON lower({collapse('trade_category')}) = key
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY nr) <= n"""


def _flagship() -> str:
    return f"""WITH {NAV},
kept AS (SELECT business_name, {url('listing_url')} AS listing_url FROM nav WHERE business_name IS NOT NULL)
SELECT regexp_extract(listing_url, '^https?://([^/]+)', 1) AS host, count(*) AS listings,
  count(DISTINCT lower(business_name)) AS names FROM kept GROUP BY 1"""
