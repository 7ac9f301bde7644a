"""Pruned crawl: only pages that a walk can reach enter the parser.

A crawl over a snapshot starts from seed pages ``(seq, url)`` and follows next
links. Each round keeps a frontier ``(seq, step, url, named)``: the page to read
next for a category, its step, and how many named cards the category holds
before it. The round semi-joins the snapshot with the frontier's URLs that no
earlier round parsed, parses just those rows, resolves their fetch attempts and
moves every category one page on: a category stops when its page failed, has no
next link, the link was already visited by that category, its named cards reach
the record limit, or ``max_pages`` pages are read (``0``: no page limit).

The budget falls as in the walk itself (a page is cut to the cards that remain,
and only named cards among them count), so the pages gathered are those that
``paginate`` visits: it gets them as its ``facts`` and gives
the same result as over a parse of the whole snapshot, while unlinked pages
never reach Python. Rounds store their tables, so a lost executor repeats one
round; the visited table grows by one row per category and page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cardfold.session import materialize, supersede
from cardfold.sources.snapshot import resolve_attempts


def reached_facts(
    snapshot: DataFrame,
    seeds: DataFrame,
    limit: int,
    max_pages: int,
    parse=None,
    attempts: int | None = None,
) -> DataFrame:
    """Resolved facts (one row per URL) of every page a category walk can reach.

    ``parse(rows)`` turns snapshot rows into fact rows (``url``, ``next_url``,
    ``named`` and the error columns); it only ever sees rows of reached URLs.
    Without ``parse`` the snapshot already holds fact rows, and without
    ``attempts`` they are already one row per URL.
    """
    parse = parse or (lambda rows: rows)
    resolve = (lambda rows: resolve_attempts(rows, attempts)) if attempts else (lambda rows: rows)
    frontier = materialize(
        seeds.select("seq", "url", F.lit(0).alias("step"), F.lit(0).cast("long").alias("named")), "frontier"
    )
    visited = materialize(frontier.select("seq", "url"), "visited")
    parsed: list[DataFrame] = []
    known = None
    while not frontier.isEmpty():
        wanted = frontier.select("url").distinct()
        if known is not None:
            wanted = wanted.join(known, "url", "left_anti")
        rows = snapshot.join(wanted, "url", "left_semi")
        facts = materialize(resolve(parse(rows)), "reached")
        parsed.append(facts)
        known = facts.select("url") if known is None else known.unionByName(facts.select("url"))
        seen = reduce(DataFrame.unionByName, [p.select("url", "error_type", "next_url", "named") for p in parsed])
        page = seen.select(
            "url", F.col("error_type").isNull().alias("ok"), "next_url",
            F.coalesce("named", F.array().cast("array<int>")).alias("positions"),
        )
        # A page is cut to the cards that remain; only named cards among them count.
        remaining = F.lit(limit) - F.col("named")
        taken = F.size(F.filter("positions", lambda p: p <= remaining)).cast("long")
        step = frontier.join(page, "url").withColumn("n_named", taken)
        go_on = F.col("ok") & F.col("next_url").isNotNull() & (F.col("named") + F.col("n_named") < limit)
        if max_pages > 0:
            go_on = go_on & (F.col("step") + 1 < max_pages)
        moved = step.where(go_on).select(
            "seq",
            F.col("next_url").alias("url"),
            (F.col("step") + 1).alias("step"),
            (F.col("named") + F.col("n_named")).alias("named"),
        )
        moved = moved.join(visited, ["seq", "url"], "left_anti")
        frontier = supersede(frontier, moved, "frontier")
        visited = supersede(visited, visited.unionByName(frontier.select("seq", "url")), "visited")
    if not parsed:
        return resolve(parse(snapshot.limit(0)))
    return reduce(DataFrame.unionByName, parsed)
