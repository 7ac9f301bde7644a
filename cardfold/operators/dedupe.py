"""Alias deduplication: a chain of one-pass decisions as a parent forest.

A record joins the group its first already-known alias points to, and then
points *all* its aliases there. An alias therefore always belongs to the group
of its latest earlier holder, so every record has at most one parent: the
latest earlier holder of its first known alias. Groups are the trees of that
forest (they are not the connected components of shared aliases).

Holders of one alias that all joined through it form a run with a single root,
so a record points straight to the run's head: the latest earlier holder that
did *not* join through the alias. That keeps trees shallow however many records
share an alias.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardfold.functions.phone import phone_match_key
from cardfold.functions.text import clean_text, completeness
from cardfold.functions.urls import clean_url
from cardfold.schema import OUTPUT_FIELDS
from cardfold.session import materialize, supersede


def alias_rows(records: DataFrame, *keep: Column) -> DataFrame:
    """Aliases of every record in order of precedence: ``ord``, kept columns,
    ``rank``, ``alias``.

    The keys are plain columns of their own first, so each is computed once.
    """
    keys = records.select(
        "ord",
        *keep,
        F.lower(F.coalesce(clean_text(F.col("business_name")), F.lit(""))).alias("_name"),
        phone_match_key(F.col("phone")).alias("_phone"),
        F.lower(clean_text(F.col("region"))).alias("_region"),
        clean_url(F.col("listing_url")).alias("_url"),
        F.coalesce(clean_text(F.col("source_url")), F.lit("")).alias("_source"),
    )
    named = F.col("_name") != ""

    def alias(rank: int, present: Column, *parts: str) -> Column:
        # The separator is never part of collapsed text.
        key = F.concat_ws("\x1f", F.lit(str(rank)), *parts)
        return F.when(present, F.struct(F.lit(rank).alias("rank"), key.alias("alias")))

    by_url = F.col("_url").isNotNull()
    by_phone = named & F.col("_phone").isNotNull()
    by_region = named & F.col("_region").isNotNull()
    aliases = F.array(
        alias(0, by_url, "_url"),
        alias(1, by_phone, "_name", "_phone"),
        alias(2, by_region, "_name", "_region"),
        alias(3, ~(by_url | by_phone | by_region), "_name", "_source"),
    )
    kept = [name for name in keys.columns if not name.startswith("_")]
    rows = keys.select(*kept, F.explode(aliases).alias("a"))
    return rows.where(F.col("a").isNotNull()).select(*kept, "a.rank", "a.alias")


def _fullest(ord_: Column, filled: Column) -> Column:
    """The ``ord`` of the fullest member, the earliest of equals. One partially
    aggregated minimum for each possible fullness."""
    earliest = [F.min(F.when(filled == n, ord_)) for n in range(len(OUTPUT_FIELDS), -1, -1)]
    return F.coalesce(*earliest)


def _latest_anchor(events: DataFrame) -> DataFrame:
    """For each chooser the latest earlier anchor of its alias: ``(ord, parent)``.

    ``events`` has ``rank, first, ord, anchor`` (rank and first holder name an
    alias). It is cut into ranges of ``ord``; a hot alias is then sorted range by
    range, and only one row per alias and range carries its last anchor over.
    """
    alias = ["rank", "first"]
    anchor_ord = F.when(F.col("anchor"), F.col("ord"))
    ranged = events.repartitionByRange("ord")
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "anchors")
    inside = Window.partitionBy(*alias, "part").orderBy("ord").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = Window.partitionBy(*alias).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        ranged.groupBy(*alias, "part")
        .agg(F.max(anchor_ord).alias("last"))
        .select(*alias, "part", F.max("last").over(before).alias("carried"))
    )
    found = ranged.withColumn("near", F.max(anchor_ord).over(inside)).join(
        carried, [*alias, "part"]
    )
    parent = F.coalesce("near", "carried", "first")
    return found.where(~F.col("anchor")).select("ord", parent.alias("parent"))


def _roots(edges: DataFrame) -> DataFrame:
    """Root of every child, by doubling the length of all paths per round."""
    edges = materialize(edges, "edges")
    while True:
        up = edges.select(F.col("ord").alias("parent"), F.col("parent").alias("above"))
        if up.join(edges.select("parent").distinct(), "parent", "left_semi").isEmpty():
            return edges
        edges = supersede(
            edges,
            edges.join(up, "parent", "left").select(
                "ord", F.coalesce("above", "parent").alias("parent")
            ),
            "edges",
        )


def _shared_aliases(records: DataFrame) -> DataFrame:
    """Records that share an alias with another: ``ord``, ``filled``, the first
    holder of each shared alias (``first_0`` .. ``first_3`` by rank) and ``via``,
    the rank of the alias the record joins a group through, if any.

    A record has one alias per rank at most, so rank and first holder name an
    alias from here on, and no text is shuffled again.
    """
    filled = completeness(*[F.col(name) for name in OUTPUT_FIELDS])
    holders = alias_rows(records, filled.alias("filled"))
    firsts = (
        holders.groupBy("alias")
        .agg(F.min("ord").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    shared = (
        holders.join(firsts, "alias")
        .select("ord", "filled", "rank", "first")
        .groupBy("ord")
        .agg(
            F.max("filled").alias("filled"),
            *[
                F.max(F.when(F.col("rank") == rank, F.col("first"))).alias(f"first_{rank}")
                for rank in range(4)
            ],
        )
    )
    via = F.coalesce(
        *[F.when(F.col(f"first_{rank}") < F.col("ord"), F.lit(rank)) for rank in range(4)]
    )
    return shared.withColumn("via", via)


def parent_edges(shared: DataFrame) -> DataFrame:
    """``(ord, parent)`` for every record that joins an earlier group."""
    # Every later holder of a URL joins through it, so its run starts at the
    # first holder; the same holds for records known by nothing but their name.
    direct = shared.where(F.col("via").isin(0, 3)).select(
        "ord", F.coalesce(F.when(F.col("via") == 0, F.col("first_0")), "first_3").alias("parent")
    )
    # Per name alias the later holders: choosers joined through it, anchors not.
    held = shared.select(
        "ord",
        "via",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(rank).alias("rank"), F.col(f"first_{rank}").alias("first"))
                    for rank in (1, 2)
                ]
            )
        ),
    ).where(F.col("first") < F.col("ord"))
    events = held.select("rank", "first", "ord", (F.col("via") != F.col("rank")).alias("anchor"))
    chosen = events.where(~F.col("anchor")).select("rank", "first").distinct()
    events = events.join(chosen, ["rank", "first"], "left_semi")
    return direct.unionByName(_latest_anchor(events))


def group_winners(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that share an alias, and ``(ord, founder)`` of the winners among
    them: one per group, the fullest record, the earliest of equals."""
    shared = materialize(_shared_aliases(records), "shared")
    roots = _roots(parent_edges(shared))
    members = shared.select("ord", "filled").join(roots, "ord", "left")
    winners = (
        members.groupBy(F.coalesce("parent", "ord").alias("founder"))
        .agg(_fullest(F.col("ord"), F.col("filled")).alias("ord"))
        .select("ord", "founder")
    )
    return shared.select("ord"), winners


def deduplicate(records: DataFrame) -> DataFrame:
    """One record per group, with ``founder``: the ``ord`` of the record that
    opened the group. Sort by ``founder`` for the output order.

    ``records`` is read several times: pass a stored table, not a long lineage.
    """
    involved, winners = group_winners(records)
    # One row per involved record; losers have no founder.
    verdict = (
        involved.select("ord", F.lit(None).cast("long").alias("founder"))
        .unionByName(winners)
        .groupBy("ord")
        .agg(F.max("founder").alias("founder"), F.lit(True).alias("involved"))
    )
    return (
        records.join(verdict, "ord", "left")
        .where(F.col("involved").isNull() | F.col("founder").isNotNull())
        .withColumn("founder", F.coalesce("founder", "ord"))
        .drop("involved")
    )


def founders(records: DataFrame) -> DataFrame:
    """Only the ``ord`` of the records that open a group: no loop, no join back
    of whole records. Their number is the size of the deduplicated table."""
    # A founder is the first holder of every alias it has: per record, count
    # its aliases and those it is the first holder of.
    holders = alias_rows(records)
    firsts = holders.groupBy("alias").agg(F.min("ord").alias("ord"))
    held = holders.select("ord", F.lit(1).alias("held"), F.lit(0).alias("opened"))
    opened = firsts.select("ord", F.lit(0).alias("held"), F.lit(1).alias("opened"))
    return (
        held.unionByName(opened)
        .groupBy("ord")
        .agg(F.sum("held").alias("held"), F.sum("opened").alias("opened"))
        .where(F.col("held") == F.col("opened"))
        .select("ord")
    )
