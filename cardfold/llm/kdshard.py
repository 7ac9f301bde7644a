"""Sharding by k-d tree partitioning, on DataFrame functions only.

A node is split along its widest metadata dimension (extent against the whole
table's) at the exact weighted median, or for an odd number of shards at the
matching share, until every leaf holds one shard's bytes. All nodes of a level are
split together. The cut of a node is found by distributed histograms: sizes are
summed by bins of the dimension, and the bin that holds the cut is refined until
one row is left; rows that tie in the dimension are ordered by a hash of their id,
so a source with a third of all rows is cut like any other range.

The driver holds the tree and, at each step, at most ``_CELLS`` histogram cells
over all nodes. Text is read once, for its length and checksum.

The law is ``bytes``: sizes of shards are nearly equal, each cut is at the row
boundary nearest to its share. Slots number a shard's rows without gaps.

Defined results. Null text: size 16, checksum 0. Null metadata counts as empty
text or 0. Rows equal in id and text stay in one shard. Fewer rows than shards
leave shards empty. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cardfold.llm.common import store
from cardfold.llm.packing import numbered

ROW_BYTES = 16
_CELLS = 1 << 18
_TOP = (1 << 63) - 1


@dataclass
class _Node:
    """A node to split into ``shards`` leaves, and its cut as far as it is known."""

    shards: int
    dim: int = 0
    low: int = 0
    high: int = 0
    need: float = 0.0  # weight to put left, of what is in the range
    value: int | None = None  # the cut's value, once only ties are left
    tie: int = _TOP
    closed: bool = False
    whole: bool = True  # the row of the cut itself goes left


def _lookup(values: list, kind: str, at: Column) -> Column:
    return F.get(F.array(*(F.lit(v).cast(kind) for v in values)), at)


def _position(nodes: list[_Node], dims: list[str], at: Column) -> Column:
    """The row's value in the dimension of its node."""
    return F.get(F.array(*dims), _lookup([n.dim for n in nodes], "int", at))


def _refine(rows: DataFrame, nodes: list[_Node], dims: list[str]) -> None:
    """One histogram over the open ranges; every open node's range shrinks or closes."""
    open_nodes = [n for n in nodes if not n.closed]
    bins = max(16, min(1024, _CELLS // len(open_nodes)))
    shifts = [max(0, (n.high - n.low).bit_length() - bins.bit_length() + 1) for n in nodes]
    at = F.col("node")
    value = _lookup([n.value if n.value is not None else -1 for n in nodes], "bigint", at)
    tied = _lookup([n.value is not None for n in nodes], "boolean", at)
    inside = _lookup([not n.closed for n in nodes], "boolean", at)
    own = _position(nodes, dims, at)
    x = F.when(tied, F.col("tie")).otherwise(own)
    rows = rows.where(inside & (~tied | (own == value))).withColumn("x", x)
    low, high = (_lookup(v, "bigint", at) for v in ([n.low for n in nodes], [n.high for n in nodes]))
    rows = rows.where((F.col("x") >= low) & (F.col("x") <= high))
    # shiftright takes a constant; a division by a power of two does the same
    step = _lookup([1 << s for s in shifts], "bigint", at)
    cell = F.floor((F.col("x") - low - (F.col("x") - low) % step) / step)
    found = rows.groupBy("node", cell.alias("cell")).agg(
        F.sum("size").alias("w"), F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")
    )
    by_node: dict[int, list] = {}
    for r in found.collect():
        by_node.setdefault(r["node"], []).append(r)
    for i, node in enumerate(nodes):
        if node.closed:
            continue
        for r in sorted(by_node.get(i, []), key=lambda r: r["a"]):
            if r["w"] < node.need:
                node.need -= r["w"]
                last = r
                continue
            node.low, node.high = r["a"], r["b"]
            if r["a"] == r["b"]:
                if node.value is None and r["n"] > 1:
                    node.value, node.low, node.high = r["a"], 0, _TOP
                else:
                    if node.value is None:
                        node.value = r["a"]
                    else:
                        node.tie = r["a"]
                    node.whole = node.need * 2 >= r["w"]
                    node.closed = True
            break
        else:  # rounding: all rows go left
            node.value, node.tie, node.closed = _TOP, _TOP, True


def assign(rows: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """``rows`` (size, tie and the long columns ``dims``) with a shard from 0."""
    level, rows = [_Node(shards)], rows.withColumn("node", F.lit(0))
    extent: list[float] | None = None
    while any(n.shards > 1 for n in level):
        measures = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
        stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("w"), *measures).collect()}
        for i, node in enumerate(level):
            r = stats.get(i)
            if node.shards == 1 or r is None:
                node.value, node.closed = _TOP, True
                continue
            spans = [r[f"max_{d}"] - r[f"min_{d}"] for d in dims]
            extent = extent or [max(s, 1) for s in spans]
            node.dim = max(range(len(dims)), key=lambda d: (spans[d] / extent[d], -d))
            node.low, node.high = r[f"min_{dims[node.dim]}"], r[f"max_{dims[node.dim]}"]
            node.need = r["w"] * (node.shards // 2) / node.shards
        while not all(n.closed for n in level):
            _refine(rows, level, dims)
        at, x = F.col("node"), _position(level, dims, F.col("node"))
        value, tie = (_lookup(v, "bigint", at) for v in ([n.value for n in level], [n.tie for n in level]))
        whole = _lookup([n.whole for n in level], "boolean", at)
        left = (x < value) | ((x == value) & ((F.col("tie") < tie) | ((F.col("tie") == tie) & whole)))
        # A cut without tie is a single row of that value.
        single = _lookup([n.tie == _TOP for n in level], "boolean", at)
        left = F.when(single, (x < value) | ((x == value) & whole)).otherwise(left)
        # Written each level: the next one's expressions use the node many times.
        rows = store(rows.withColumn("node", at * 2 + F.when(left, 0).otherwise(1)), "nodes")
        level = [_Node(k) for n in level for k in ((n.shards // 2, n.shards - n.shards // 2) if n.shards > 1 else (n.shards, 0))]
    first, numbers = 0, []
    for node in level:
        numbers.append(first)
        first += node.shards
    return rows.withColumn("shard", _lookup(numbers, "int", F.col("node"))).drop("node")


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labels: tuple[str, ...] = ("lang", "source"),
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; ``shards`` or bytes a shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *(F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")).alias(f"dim_{c}") for c in labels),
    )
    tie = F.shiftrightunsigned(F.xxhash64("id", "text_crc32", "size"), 2)
    rows = store(rows.withColumn("tie", tie), "metadata")
    if shards is None:
        total = rows.agg(F.sum("size").alias("w")).first()["w"] or 0
        shards = max(1, -(-total // (target_bytes or 1)))
    placed = assign(rows, ["size", *(f"dim_{c}" for c in labels)], shards)
    placed = store(placed.select("id", "size", "text_crc32", "shard"), "shards")
    return numbered(placed, "shard", ["id", "text_crc32"], "slot")
