"""A Merkle manifest of a document table, with a proof for every row.

Tree. Each row is a leaf: the SHA-256 (lowercase hex) of its fields doc_id,
source, lang, n_chars and text, each written ``-`` if null, else as its UTF-8
byte count, ``:`` and its value (integers in decimal). Within a source the
leaves ascend by doc_id (null first; equal ids by leaf digest). While a level
has more than one node, every three consecutive nodes (the last run may hold
fewer, even one) are replaced by the hash of their concatenated hex digests. The
one node left is the source's subroot; the subroots, ordered by source (null
first, UTF-8 bytewise), form the top tree the same way and give the root.

Method: incremental witnesses over aligned blocks. Positions are cut into blocks
of ``3**depth`` leaves that line up with the tree's runs, so each block holds
whole subtrees. A task streams the leaves of a block through an append-only
frontier: every append goes into the open run of its level, and when a run
closes (three nodes, or the end of the block) its hash is appended to the level
above, while each leaf below a child of the closed run gets the run's other
members as its next partial witness (left part, right part). The block roots are
then treated as further appends of the level above, block by block again, until
one node is left per source; the subroots are appended to the top tree the same
way. Witnesses are finally extended top-down by joins on (source, block), which
never meet more than one block's rows a key, so a source with a third of all
rows is cut like any other.

Verification folds a leaf with its witness: ``H(left + node + right)`` level by
level; all native Spark columns.

Defined results. Null fields are ``-``; an empty table gives no rows; a source
with one row has that leaf as subroot; one source makes its subroot the root;
repeated rows are separate leaves (equal digests, adjacent). Columns other than
the five fields are not read, so extra columns never clash.

Scale. Only (source, doc_id, digests) are shuffled: one range exchange for the
order within sources, then one grouping by (source, block) per 3**depth-fold
level and one join per level on the way down.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardfold.llm.common import store

#: Tree arity and the default block depth (blocks of 3**7 = 2,187 nodes).
ARITY = 3
DEPTH = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))).cast("binary"), 256)


def _ranked(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``df`` with ``pos``: gapless from 0 within ``key`` in ``order``.

    Rows are cut into ranges of (key, order), each range counts its own rows per
    key, and only those counts travel: a hot key spans many ranges.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key).asc_nulls_first(), *order, F.col("_m_tie")]
    ranged = df.withColumn("_m_tie", F.rand(7)).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    ranged = ranged.withColumns({"_m_part": F.spark_partition_id(), "_m_row": F.monotonically_increasing_id()})
    ranged = store(ranged.drop("_m_tie"), "manifest-ranked")
    counts = ranged.groupBy(key, "_m_part").agg(F.count("*").alias("_m_n"), F.min("_m_row").alias("_m_first"))
    before = Window.partitionBy(key).orderBy("_m_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(key).alias("_m_key"), F.col("_m_part").alias("_m_at"), "_m_first",
        F.coalesce(F.sum("_m_n").over(before), F.lit(0)).alias("_m_before"),
    )
    on = F.col(key).eqNullSafe(F.col("_m_key")) & (F.col("_m_part") == F.col("_m_at"))
    joined = ranged.join(counts, on).drop("_m_at")
    pos = F.col("_m_before") + F.col("_m_row") - F.col("_m_first")
    return joined.withColumn("pos", pos).drop("_m_key", "_m_part", "_m_row", "_m_first", "_m_before")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold_block(digests: list[str], top: int) -> tuple[str, list[list[str]], list[list[str]]]:
    """Stream ``digests`` through an append-only frontier up to level ``top``.

    Returns the block root and, per input node, its partial witness: the left and
    right siblings of each level, from the bottom. At the end the open runs are
    closed bottom-up, so runs of fewer than three nodes are hashed too.
    """
    lefts: list[list[str]] = [[] for _ in digests]
    rights: list[list[str]] = [[] for _ in digests]
    frontier: list[list[tuple[str, int, int]]] = [[] for _ in range(top)]
    done: list[tuple[str, int, int]] = []

    def close(level: int) -> None:
        run, frontier[level] = frontier[level], []
        hexes = [d for d, _, _ in run]
        for j, (_, lo, hi) in enumerate(run):
            left, right = "".join(hexes[:j]), "".join(hexes[j + 1 :])
            for i in range(lo, hi):  # every leaf below this child waits for this level
                lefts[i].append(left)
                rights[i].append(right)
        append(level + 1, (_sha("".join(hexes)), run[0][1], run[-1][2]))

    def append(level: int, node: tuple[str, int, int]) -> None:
        if level == top:
            done.append(node)
            return
        frontier[level].append(node)
        if len(frontier[level]) == ARITY:
            close(level)

    for i, d in enumerate(digests):
        append(0, (d, i, i + 1))
    for level in range(top):
        if frontier[level]:
            close(level)
    assert len(done) == 1
    return done[0][0], lefts, rights


def levels_for(n: int) -> int:
    """Levels of a tree of ``n`` nodes: until one is left."""
    h, width = 0, n
    while width > 1:
        width = -(-width // ARITY)
        h += 1
    return h


def _fold(nodes: DataFrame, depth: int) -> DataFrame:
    """(key, pos, digest) -> (key, pos, block, lefts, rights, root): one group a block.

    A block that is the key's first and not full is the key's only block: it is
    folded until one node is left. Every other block is folded ``depth`` levels,
    which is what the whole tree does there, as each lower level has many nodes.
    """
    width = ARITY**depth
    schema = "key string, key_null boolean, pos long, block long, lefts array<string>, rights array<string>, root string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        block = int(pdf["block"].iloc[0])
        n = len(pdf)
        top = levels_for(n) if block == 0 and n < width else depth
        root, lefts, rights = fold_block(pdf["digest"].tolist(), top)
        return pd.DataFrame(
            {
                "key": pdf["key"].to_numpy(),
                "key_null": pdf["key_null"].to_numpy(),
                "pos": pdf["pos"].to_numpy(),
                "block": block,
                "lefts": lefts,
                "rights": rights,
                "root": root,
            }
        )

    blocked = nodes.withColumn("block", F.floor(F.col("pos") / width).cast("long"))
    return blocked.groupBy("key", "key_null", "block").applyInPandas(run, schema)


def _tree(nodes: DataFrame, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Fold (key, key_null, pos, digest) until each key has one node.

    Returns the stored level tables, bottom first, and the tops (key, key_null, digest).
    """
    levels = []
    while not nodes.where(F.col("pos") > 0).isEmpty():
        folded = store(_fold(nodes, depth), "manifest-level")
        levels.append(folded)
        nodes = folded.where(F.col("pos") % (ARITY**depth) == 0).select(
            "key", "key_null", F.col("block").alias("pos"), F.col("root").alias("digest")
        )
    return levels, nodes


def _down(levels: list[DataFrame], upper: DataFrame, carry: list[str]) -> DataFrame:
    """Whole witnesses of the bottom level: each level's own, then those above it.

    ``upper`` holds the tops (key, key_null, pos, lefts, rights, *carry); each step
    joins a level to the level above by (key, block), at most one block a key.
    """
    for i, level in enumerate(reversed(levels)):
        above = upper.select(
            F.col("key").alias("_u_key"), F.col("key_null").alias("_u_null"), F.col("pos").alias("_u_pos"),
            F.col("lefts").alias("_u_lefts"), F.col("rights").alias("_u_rights"), *carry,
        )
        own = level.select("key", "key_null", "pos", "block", "lefts", "rights")
        on = (F.col("key") == F.col("_u_key")) & (F.col("key_null") == F.col("_u_null")) & (F.col("block") == F.col("_u_pos"))
        upper = own.join(above, on).select(
            "key", "key_null", "pos",
            F.concat("lefts", "_u_lefts").alias("lefts"),
            F.concat("rights", "_u_rights").alias("rights"),
            *carry,
        )
        if i < len(levels) - 1:
            upper = store(upper, "manifest-witness")
    return upper


def _empty_witness() -> list[Column]:
    none = F.array().cast("array<string>")
    return [F.lit(0).cast("long").alias("pos"), none.alias("lefts"), none.alias("rights")]


def manifest(docs: DataFrame, depth: int = DEPTH, carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, source, leaf, subroot, root, lefts, rights and
    the ``carry`` columns, computed in the first scan (for digests of other texts).

    ``lefts``/``rights`` hold the witness, one entry a level from the leaf up to the
    root (subtree levels, then top-tree levels); ``proof`` and ``fold`` read it.
    Texts are read once, for the leaf: no later step moves them.
    """
    carry = carry or {}
    rows = docs.select(
        "doc_id", "source", leaf_of(*(F.col(c) for c in FIELDS)).alias("leaf"),
        *(c.alias(name) for name, c in carry.items()),
    )
    rows = rows.withColumns({"key": F.coalesce(F.col("source"), F.lit("")), "key_null": F.col("source").isNull()})
    rows = _ranked(rows, "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    leaves = rows.select("key", "key_null", "pos", F.col("leaf").alias("digest"))
    levels, subroots = _tree(leaves, depth)

    # The subroots are appended to the top tree, ordered by source, null first.
    subroots = subroots.select(F.when(F.col("key_null"), F.lit(None)).otherwise(F.col("key")).alias("source"), "digest")
    top_nodes = _ranked(subroots.withColumn("one", F.lit("")), "one", [F.col("source").asc_nulls_first()])
    top_nodes = top_nodes.select(F.lit("").alias("key"), F.lit(False).alias("key_null"), "pos", "digest", "source")
    top_levels, root = _tree(top_nodes.drop("source"), depth)
    tops = root.select("key", "key_null", *_empty_witness(), F.col("digest").alias("root"))
    top_wit = _down(top_levels, tops, ["root"])
    # Each subroot with its top-tree witness: one row per source.
    per_source = top_nodes.join(top_wit, ["key", "key_null", "pos"]).select(
        F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("key_null"),
        *_empty_witness()[:1], "lefts", "rights", F.col("digest").alias("subroot"), "root",
    )
    wit = _down(levels, per_source, ["subroot", "root"])
    on = [rows["key"] == wit["key"], rows["key_null"] == wit["key_null"], rows["pos"] == wit["pos"]]
    return rows.join(wit, on).select(
        rows["doc_id"], rows["source"], "leaf", "subroot", "root", "lefts", "rights", *(rows[c] for c in carry)
    )


def proof(lefts: Column, rights: Column) -> Column:
    """H of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda l, r: F.concat(l, r)), "").cast("binary"), 256)


def fold(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that ``leaf`` gives with this witness."""
    steps = F.arrays_zip(lefts.alias("l"), rights.alias("r"))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]).cast("binary"), 256))
