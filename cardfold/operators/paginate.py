"""Bounded pagination: follow next links under page and record limits.

The walk of a category is a path in the page graph (each page has at most one
next link). Instead of one job per page depth, paths are doubled: a table of
hops over 2^i pages extends every path by 2^i steps at once, so the number of
rounds is the logarithm of the longest path. Hops also carry how many named
cards they pass, which gives every page of a path the number of listings
collected before it, as long as no page had to be cut short.

The record limit counts cards before the name check, while the remaining count
falls only by named cards. So a page that holds more cards than remain is cut,
and if some of its first cards have no name the walk goes on with the rest of
the budget. ``_spans`` works that out per category as ranges of steps.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardfold.operators.extract import listing_rows
from cardfold.operators.records import failure_columns
from cardfold.session import materialize, supersede

_ALL = (1 << 31) - 1

# Failure of a page that the snapshot does not hold.
MISSING_TYPE = "NotInSnapshot"
MISSING_MESSAGE = "The page is not part of the snapshot."


# What the walk keeps of a page: whether it was read, its cards, its cards before
# the first nameless one, its named cards.
_PAGE = ["ok", "n_cards", "lead", "n_named"]


class Pagination(NamedTuple):
    visits: DataFrame  # seq, step, url, ok, take
    listings: DataFrame  # seq, step, card, ord and the seven listing columns
    failures: DataFrame  # ord and the failure columns


def _within(named: Column, take: Column) -> Column:
    """How many of the first ``take`` cards carry a name."""
    return F.size(F.filter(named, lambda position: position <= take))


def _remaining(limit: int) -> Column:
    return F.lit(limit) - F.col("before")


def _cut_short(limit: int) -> Column:
    return (_remaining(limit) <= 0) | (F.col("n_cards") > _remaining(limit))


def _open_categories(walk: DataFrame, limit: int) -> DataFrame:
    """Categories whose known pages do not yet prove that the limit is met.

    A page that surely fits the budget gives all its named cards; any other
    page gives at least its leading named cards, or ends the budget.
    """
    sure = F.when(_cut_short(limit), F.col("lead")).otherwise(F.col("n_named"))
    return (
        walk.groupBy("seq")
        .agg(F.sum(sure).alias("sure"))
        .where(F.col("sure") < limit)
        .select("seq")
    )


def _first_hops(pages: DataFrame) -> DataFrame:
    """``url, to, gain`` and what is known of the page it leads to."""
    target = pages.select(
        F.col("url").alias("to"),
        F.struct(*_PAGE).alias("page"),
    )
    return (
        pages.where(F.col("ok") & F.col("next_url").isNotNull())
        .select(
            "url", F.col("next_url").alias("to"), F.col("n_named").cast("long").alias("gain")
        )
        .join(target, "to", "left")
        .select("url", "to", "gain", "page")
    )


def _doubled(hops: DataFrame) -> DataFrame:
    after = hops.select(
        F.col("url").alias("to"),
        F.col("to").alias("beyond"),
        F.col("gain").alias("more"),
        F.col("page").alias("there"),
    )
    return hops.join(after, "to").select(
        "url",
        F.col("beyond").alias("to"),
        (F.col("gain") + F.col("more")).alias("gain"),
        F.col("there").alias("page"),
    )


def _steps(rows: DataFrame) -> DataFrame:
    """Path rows with the page facts that the limit check needs."""
    return rows.select(
        "seq",
        "step",
        "url",
        "before",
        F.coalesce("page.ok", F.lit(False)).alias("ok"),
        *[F.coalesce(f"page.{name}", F.lit(0)).alias(name) for name in _PAGE[1:]],
    )


def walk_pages(seeds: DataFrame, pages: DataFrame, limit: int, max_pages: int) -> DataFrame:
    """Distinct pages of every category's path, at least as far as the limit
    reaches: ``seq, step, url, before, named`` and the page's counts."""
    known = pages.select("url", F.struct(*_PAGE).alias("page"))
    start = seeds.select(
        "seq", "url", F.lit(0).alias("step"), F.lit(0).cast("long").alias("before")
    )
    walk = materialize(_steps(start.join(known, "url", "left")), "walk")
    hops, reach, size = None, 1, -1
    while max_pages == 0 or reach < max_pages:
        open_seqs = _open_categories(walk, limit)
        if open_seqs.isEmpty():
            break
        hops = supersede(hops, _first_hops(pages) if hops is None else _doubled(hops), "hops")
        ahead = (
            walk.join(open_seqs, "seq", "left_semi")
            .join(hops, "url")
            .select(
                "seq",
                (F.col("step") + reach).alias("step"),
                F.col("to").alias("url"),
                (F.col("before") + F.col("gain")).alias("before"),
                "page",
            )
        )
        # A page met again keeps its first place: that ends cycles.
        walk = supersede(
            walk,
            walk.unionByName(_steps(ahead))
            .groupBy("seq", "url")
            .agg(
                F.min("step").alias("step"),
                F.min("before").alias("before"),
                *[F.max(name).alias(name) for name in _PAGE],
            ),
            "walk",
        )
        grown = walk.count()
        if grown == size:
            break
        size, reach = grown, reach * 2
    if max_pages > 0:
        walk = walk.where(F.col("step") < max_pages)
    return walk.join(pages.select("url", "named"), "url", "left").withColumn(
        "named", F.coalesce("named", F.array().cast("array<int>"))
    )


def _spans(path: DataFrame, limit: int) -> DataFrame:
    """Disjoint step ranges per category with the number of cards to take from
    each page in them: ``seq, first_step, last_step, take``."""
    cut = F.when(_cut_short(limit), F.col("step"))
    at_cut = F.struct(
        "step",
        _remaining(limit).cast("int").alias("take"),
        _within(F.col("named"), _remaining(limit)).alias("got"),
    )
    cuts = materialize(path.groupBy("seq").agg(F.min_by(at_cut, cut).alias("cut")), "cuts")
    before_cut = cuts.select(
        "seq",
        F.lit(0).alias("first_step"),
        F.coalesce(F.col("cut.step") - 1, F.lit(_ALL)).alias("last_step"),
        F.lit(_ALL).alias("take"),
    )
    short = cuts.where(F.col("cut.take") > 0)
    the_cut = short.select(
        "seq",
        F.col("cut.step").alias("first_step"),
        F.col("cut.step").alias("last_step"),
        F.col("cut.take").alias("take"),
    )
    spans = [before_cut, the_cut]
    # What is left is less than one page of cards and shrinks every round: each
    # round jumps to the next page with a named card among its first ``take``.
    state = short.select(
        "seq",
        (F.col("cut.step") + 1).alias("first_step"),
        (F.col("cut.take") - F.col("cut.got")).alias("take"),
    ).where(F.col("take") > 0)
    while not state.isEmpty():
        hits = (
            path.join(state, "seq")
            .where((F.col("step") >= F.col("first_step")) & (F.get("named", F.lit(0)) <= F.col("take")))
            .groupBy("seq")
            .agg(
                F.min_by(
                    F.struct("step", _within(F.col("named"), F.col("take")).alias("got")), "step"
                ).alias("hit")
            )
        )
        moved = materialize(state.join(hits, "seq", "left"), "budget")
        spans.append(
            moved.select(
                "seq", "first_step", F.coalesce("hit.step", F.lit(_ALL)).alias("last_step"), "take"
            )
        )
        state = moved.where(F.col("hit").isNotNull()).select(
            "seq",
            (F.col("hit.step") + 1).alias("first_step"),
            (F.col("take") - F.col("hit.got")).alias("take"),
        ).where(F.col("take") > 0)
    return reduce(DataFrame.unionByName, spans)


def _with_place(visits: DataFrame) -> DataFrame:
    """``visits`` with ``place``, the cards taken before each page in crawl order.

    Pages are cut into ranges of the crawl order; each range sums its own pages
    and only one number per range is carried over. Listings are not moved.
    """
    taken = F.when(F.col("ok"), F.col("take")).otherwise(0).cast("long")
    ranged = visits.withColumn("taken", taken).repartitionByRange("seq", "step")
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "visits")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("part")
        .agg(F.sum("taken").alias("taken"))
        .select("part", F.coalesce(F.sum("taken").over(before), F.lit(0)).alias("start"))
    )
    own = Window.partitionBy("part").orderBy("seq", "step").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("within", F.coalesce(F.sum("taken").over(own), F.lit(0)))
        .join(starts, "part")
        .withColumn("place", F.col("start") + F.col("within"))
        .drop("part", "taken", "start", "within")
    )


def paginate(
    seeds: DataFrame, facts: DataFrame, limit_per_category: int, max_pages: int = 1, reached: bool = False
) -> Pagination:
    """Visit the pages of every category in ``seeds (seq, url)``.

    ``facts`` is a stored table with one row per URL: ``url, next_url, n_cards,
    named, cards`` and the error columns of the snapshot. ``max_pages=0`` means
    no page limit. With a page limit, a frontier first narrows ``facts`` to the
    pages the walks reach (at most ``max_pages`` a category), so the hop table
    never holds the rest of the snapshot. ``reached=True`` says that ``facts``
    already holds only reached pages (as ``operators.crawl`` gives them).
    """
    if limit_per_category < 1:
        raise ValueError("limit_per_category must be greater than 0")
    if max_pages < 0:
        raise ValueError("max_pages cannot be negative")
    if max_pages > 0 and not reached:
        # Bounded walks: only the pages the walks reach, found depth by depth with
        # a running budget, enter the hop table.
        from cardfold.operators.crawl import reached_facts

        facts = reached_facts(facts, seeds, limit_per_category, max_pages)
    pages = facts.select(
        "url",
        F.col("error_type").isNull().alias("ok"),
        "next_url",
        F.coalesce("n_cards", F.lit(0)).alias("n_cards"),
        F.coalesce("named", F.array().cast("array<int>")).alias("named"),
        F.coalesce(
            F.size(F.filter("named", lambda position, i: position == i + 1)), F.lit(0)
        ).alias("lead"),
        F.coalesce(F.size("named"), F.lit(0)).alias("n_named"),
    )
    path = materialize(walk_pages(seeds, pages, limit_per_category, max_pages), "path")
    spans = _spans(path, limit_per_category)
    visits = (
        path.join(spans, "seq")
        .where(F.col("step").between(F.col("first_step"), F.col("last_step")))
        .select("seq", "step", "url", "ok", F.least("take", "n_cards").alias("take"))
    )
    placed = materialize(_with_place(visits), "visits")
    visits = placed.drop("place")
    taken = placed.where(F.col("ok") & (F.col("take") > 0)).join(
        facts.select("url", "cards"), "url"
    )
    rows = listing_rows(taken, ["seq", "step", "place"], F.slice("cards", 1, F.col("take")))
    listings = rows.withColumn("ord", F.col("place") + F.col("card")).drop("place")
    errors = facts.where(F.col("error_type").isNotNull()).select(
        "url", "error_type", "error_message", "status_code", "fetched_at"
    )
    failures = (
        visits.where(~F.col("ok"))
        .join(errors, "url", "left")
        .select(
            F.col("seq").cast("long").alias("ord"),
            *failure_columns(
                F.col("url"),
                F.coalesce("error_type", F.lit(MISSING_TYPE)),
                F.when(F.col("error_type").isNull(), F.lit(MISSING_MESSAGE)).otherwise(
                    F.coalesce("error_message", F.lit(""))
                ),
                F.col("status_code"),
                F.col("fetched_at"),
            ),
        )
    )
    return Pagination(visits, listings, failures)
