"""Listings, categories, next links and descriptions from parsed pages.

``page_facts`` answers every question about a page from one parse; the
functions below it each ask for just the parts they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardfold import schema
from cardfold.functions.phone import decode_tel
from cardfold.functions.text import WS, clean_display_text, listed_count
from cardfold.operators.html import (
    first_inside,
    has,
    href_of,
    parse_pages,
    select_all,
    select_one,
    selector_bits,
    text_of,
)

_CATEGORY_SELECTORS = {
    "category_link": schema.CATEGORY_LINK_SELECTOR,
    "category_card": schema.CATEGORY_CARD_SELECTOR,
    "category_name": schema.CATEGORY_NAME_SELECTOR,
    "category_count": schema.CATEGORY_COUNT_SELECTOR,
}
_TEXT_FIELDS = ["business_name", "trade_category", "region", "description"]
# What is looked up inside a listing card and inside a category card.
_CARD_FIELDS = [*_TEXT_FIELDS, "phone", "listing_url"]
_CATEGORY_CARD_FIELDS = ["category_name", "category_count"]


def merge_selectors(overrides: dict[str, str] | None) -> dict[str, str]:
    """Default listing selectors with single keys replaced."""
    unknown = set(overrides or {}) - set(schema.LISTING_SELECTORS)
    if unknown:
        raise ValueError(f"unknown selector keys: {', '.join(sorted(unknown))}")
    return {**schema.LISTING_SELECTORS, **(overrides or {})}


def _cards(bits: dict[str, int], limit: int | None) -> Column:
    """Per listing card, the raw values of its fields, in document order."""
    els, texts = F.col("els"), F.col("texts")
    cards = select_all(els, bits["listing"])
    if limit is not None:
        cards = F.slice(cards, 1, limit)

    def first_hits(card: Column) -> Column:
        return F.struct(
            *[first_inside(els, card, k).alias(name) for k, name in enumerate(_CARD_FIELDS)]
        )

    def fields(hit: Column, index: Column) -> Column:
        return F.struct(
            index.alias("card"),
            *[text_of(hit[name], texts).alias(name) for name in _TEXT_FIELDS],
            text_of(hit["phone"], texts).alias("phone_text"),
            hit["phone"]["href"].alias("phone_href"),
            href_of(hit["listing_url"]).alias("listing_url"),
        )

    return F.transform(F.transform(cards, first_hits), fields)


def _named(cards: Column) -> Column:
    """1-based positions of the cards that carry a name."""
    return F.transform(
        F.filter(cards, lambda c: F.coalesce(c["business_name"] != "", F.lit(False))),
        lambda c: c["card"] + 1,
    )


def _category_mentions(bits: dict[str, int]) -> Column:
    """Category links (pass 1), then category cards (pass 2)."""
    els, texts = F.col("els"), F.col("texts")
    listing = bits.get("listing", 0)

    def field(card: Column, k: int) -> Column:
        # In a listing card that is a category card too, the listing's fields come first.
        return first_inside(els, card, k, F.when(has(card, listing), len(_CARD_FIELDS)).otherwise(0))

    links = F.transform(
        select_all(els, bits["category_link"]),
        lambda e: F.struct(
            F.lit(1).alias("pass"),
            e["at"].alias("at"),
            e["href_abs"].alias("url"),
            text_of(e, texts).alias("name"),
            F.lit(None).cast("string").alias("count_text"),
        ),
    )
    cards = F.transform(
        select_all(els, bits["category_card"]),
        lambda e: F.struct(
            F.lit(2).alias("pass"),
            e["at"].alias("at"),
            e["data_url_abs"].alias("url"),
            text_of(field(e, 0), texts).alias("name"),
            text_of(field(e, 1), texts).alias("count_text"),
        ),
    )
    return F.concat(links, cards)


def _next_url(bits: dict[str, int]) -> Column:
    """Link of the best next-page rule, first in document order within it."""
    texts = F.col("texts")

    def candidate(e: Column) -> Column:
        anchor = e["tag"] == "a"
        rule = (
            F.when(F.coalesce(e["rel"].rlike(rf"(?i)(^|{WS})next({WS}|$)"), F.lit(False)), 1)
            .when(anchor & F.coalesce(F.lower(e["cls"]).contains("next"), F.lit(False)), 2)
            .when(anchor & F.lower(text_of(e, texts)).contains("next"), 3)
            .when(anchor & e["href"].contains("/page/"), 4)
        )
        return F.struct(rule.alias("rule"), e["at"].alias("at"), e["href_abs"].alias("url"))

    ranked = F.filter(
        F.transform(select_all(F.col("els"), bits["next_link"]), candidate),
        lambda c: c["rule"].isNotNull(),
    )
    return F.array_min(ranked)["url"]


def page_facts(
    pages: DataFrame,
    selectors: dict[str, str] | None = None,
    detail_selector: str = schema.DETAIL_SELECTOR,
    parts: tuple[str, ...] = ("cards", "categories", "next", "detail"),
    limit: int | None = None,
    url_col: str = "url",
    html_col: str = "html",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per page with the requested parts, from a single parse; ``absent``
    marks a null page.

    ``cards`` gives ``cards`` (raw fields per card), ``n_cards`` and ``named``
    (1-based positions of cards with a name); ``categories`` gives
    ``mentions``; ``next`` gives ``next_url``; ``detail`` gives ``detail_text``.
    """
    wanted: dict[str, str] = {}
    if "cards" in parts:
        wanted.update(merge_selectors(selectors))
    if "categories" in parts:
        wanted.update(_CATEGORY_SELECTORS)
    if "next" in parts:
        wanted["next_link"] = "a[href], link[href]"
    if "detail" in parts:
        wanted["detail"] = detail_selector
    keep = list(keep if keep is not None else [url_col])
    bits = selector_bits(wanted)
    scopes = {"listing": _CARD_FIELDS} if "cards" in parts else {}
    if "categories" in parts:
        scopes["category_card"] = _CATEGORY_CARD_FIELDS
    parsed = parse_pages(pages, wanted, url_col, html_col, keep, scopes)
    columns = [F.col(name) for name in keep]
    columns += [F.col("parse_error"), F.col("els").isNull().alias("absent")]
    if "cards" in parts:
        columns.append(_cards(bits, limit).alias("cards"))
    if "categories" in parts:
        columns.append(_category_mentions(bits).alias("mentions"))
    if "next" in parts:
        columns.append(_next_url(bits).alias("next_url"))
    if "detail" in parts:
        columns.append(
            clean_display_text(
                text_of(select_one(F.col("els"), bits["detail"]), F.col("texts"))
            ).alias("detail_text")
        )
    facts = parsed.select(*columns)
    if "cards" in parts:
        facts = facts.withColumns(
            {"n_cards": F.size("cards"), "named": _named(F.col("cards"))}
        )
    return facts


def listing_fields(
    card: Column, source_url: Column, phone_prefers: str = "text"
) -> list[Column]:
    """The seven listing columns from one raw card."""
    if phone_prefers == "text":
        phone = F.coalesce(F.nullif(card["phone_text"], F.lit("")), decode_tel(card["phone_href"]))
    else:
        phone = F.coalesce(decode_tel(card["phone_href"]), clean_display_text(card["phone_text"]))
    return [
        clean_display_text(card["business_name"]).alias("business_name"),
        clean_display_text(card["trade_category"]).alias("trade_category"),
        clean_display_text(card["region"]).alias("region"),
        phone.alias("phone"),
        clean_display_text(card["description"]).alias("description"),
        card["listing_url"].alias("listing_url"),
        source_url.alias("source_url"),
    ]


def listing_rows(
    facts: DataFrame,
    keep: list[str],
    cards: Column | None = None,
    source_url: str = "url",
    phone_prefers: str = "text",
) -> DataFrame:
    """One row per named card: ``keep`` columns, ``card`` position, listing."""
    named = F.filter(
        F.col("cards") if cards is None else cards,
        lambda c: F.coalesce(c["business_name"] != "", F.lit(False)),
    )
    columns = list(dict.fromkeys([*keep, source_url]))
    rows = facts.select(*columns, F.explode(named).alias("_card"))
    return rows.select(
        *keep,
        F.col("_card.card").alias("card"),
        *listing_fields(F.col("_card"), F.col(source_url), phone_prefers),
    )


def count_cards(
    pages: DataFrame, selectors: dict[str, str] | None = None, url_col: str = "url"
) -> DataFrame:
    """Listing cards per page; pages without any give 0."""
    wanted = {"listing": merge_selectors(selectors)["listing"]}
    parsed = parse_pages(pages, wanted, url_col)
    return parsed.select(
        F.col(url_col).alias("url"), F.coalesce(F.size("els"), F.lit(0)).alias("n_cards")
    )


def extract_listings(
    pages: DataFrame,
    limit: int = schema.DEFAULT_PAGE_LIMIT,
    selectors: dict[str, str] | None = None,
    url_col: str = "url",
) -> DataFrame:
    """Listings of directory pages: the first ``limit`` cards of each page,
    less those without a name. ``card`` counts from 0 in document order."""
    if limit < 1:
        raise ValueError("limit must be greater than 0")
    facts = page_facts(pages, selectors, parts=("cards",), limit=limit, url_col=url_col)
    return listing_rows(facts, [], source_url=url_col)


def extract_listings_generic(
    pages: DataFrame, selectors: dict[str, str] | None = None, url_col: str = "url"
) -> DataFrame:
    """Listings of any directory: no limit, phone links preferred to phone text."""
    facts = page_facts(pages, selectors, parts=("cards",), url_col=url_col)
    return listing_rows(facts, [], source_url=url_col, phone_prefers="href")


def extract_detail(
    pages: DataFrame, selector: str = schema.DETAIL_SELECTOR, url_col: str = "url"
) -> DataFrame:
    """Description of each detail page; null where the container is missing."""
    facts = page_facts(pages, detail_selector=selector, parts=("detail",), url_col=url_col)
    return facts.select(F.col(url_col).alias("url"), F.col("detail_text").alias("description"))


def next_page(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Next-page link of each page; null where there is none."""
    facts = page_facts(pages, parts=("next",), url_col=url_col)
    return facts.select(F.col(url_col).alias("url"), "next_url")


def categories_from_facts(facts: DataFrame, url_col: str = "url") -> DataFrame:
    """Categories per directory page from its ``mentions``.

    The first link names a category and fixes its place; the last card with the
    same URL overrides name and count. Sort by ``source_url, sort_key, first_at``
    for the reading order.
    """
    named = F.filter("mentions", lambda m: (m["name"] != "") & (m["url"] != ""))
    rows = facts.select(F.col(url_col).alias("source_url"), F.explode(named).alias("m"))
    place = F.col("m.pass") * F.lit(1 << 40) + F.col("m.at")
    merged = (
        rows.groupBy("source_url", F.col("m.url").alias("category_url"))
        .agg(
            F.min(place).alias("first_at"),
            F.min_by("m.name", F.when(F.col("m.pass") == 1, F.col("m.at"))).alias("link_name"),
            F.max_by(
                F.struct("m.name", "m.count_text"), F.when(F.col("m.pass") == 2, F.col("m.at"))
            ).alias("card"),
        )
    )
    name = clean_display_text(F.coalesce(F.col("card.name"), F.col("link_name")))
    cleaned = merged.select(
        "source_url",
        name.alias("trade_category"),
        "category_url",
        listed_count(F.col("card.count_text")).alias("listed_count"),
        "first_at",
    )
    return cleaned.withColumn("sort_key", F.lower("trade_category"))


def discover_categories(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Category names, URLs and optional counts of directory pages."""
    return categories_from_facts(page_facts(pages, parts=("categories",), url_col=url_col), url_col)
