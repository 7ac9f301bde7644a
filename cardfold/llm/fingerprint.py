"""Threshold-scaled sketches of documents, on DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so two
sketches of very unequal documents still estimate containment, and the sketch of a
union is the union of sketches. Shingles are runs of five words, hashed to 64 bits.
The fingerprint is the sorted hashes of the sketch in hex; a text with words whose
sketch is empty has its smallest hash as fingerprint, which tells texts apart but
takes no part in likeness.

Likeness of a to b is the containment: the share of a's sketch that b's has. A text
with fewer than ``FEW`` kept hashes is compared by all its hashes with all of b's.

Defined results. Null or empty text: no shingles, empty fingerprint; fewer than five
words: the whole sequence is the one shingle. The likeness of a text without shingles
is 1 to another one, else 0. Equal texts have equal fingerprints. Repeated ids are
ordered by a hash of their texts; rows without an id come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHINGLE = 5
#: One hash in ``SCALE`` is kept.
SCALE = 8
#: Sketches with fewer hashes than this estimate nothing; the whole texts are compared.
FEW = 8


def with_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE, all_out: str | None = None) -> DataFrame:
    """``df`` with the sorted kept hashes of the text as an array of longs.

    ``all_out`` names a column for the sorted hashes of all shingles.
    """
    words, hashes = f"{out}_words", all_out or f"{out}_hashes"
    split = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    df = df.withColumn(words, F.filter(split, lambda w: w != ""))
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
    each = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))))
    each = F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(hashes, F.sort_array(F.array_distinct(each)))
    below = F.lit(min((1 << 64) // scale - (1 << 63), (1 << 63) - 1))
    df = df.withColumn(out, F.filter(hashes, lambda h: h < below) if scale > 1 else F.col(hashes))
    return df.drop(words) if all_out else df.drop(words, hashes)


def fingerprint(sketch: Column, hashes: Column | None = None) -> Column:
    """The sketch in hex; with ``hashes``, those of all shingles, the smallest of them for an empty sketch."""
    if hashes is not None:
        sketch = F.when(F.size(sketch) > 0, sketch).otherwise(F.slice(hashes, 1, 1))
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def containment(a: Column, b: Column, all_a: Column | None = None, all_b: Column | None = None) -> Column:
    """The share of ``a`` that ``b`` has; with all hashes given, those decide where ``a`` keeps few."""
    empty = F.when(F.size(b) == 0, 1.0).otherwise(0.0)
    share = F.when(F.size(a) == 0, empty).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))
    if all_a is None or all_b is None:
        return share
    return F.when(F.size(a) < FEW, containment(all_a, all_b)).otherwise(share)


def with_next(df: DataFrame, id_col: str, tie: str, columns: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with ``next_<column>``: values of the next row by descending id; the last row's is the first.

    Rows are dealt into ranges of the id, so each is ordered alone; a copy of each
    range's first row ends the range above it.
    """
    spark = df.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(id_col, shares, 100 * parts)).first()[0] or []
    bounds = F.array(*(F.lit(b).cast("bigint") for b in sorted(set(found))))
    part = F.size(F.filter(bounds, lambda b: b < F.col(id_col))) if found else F.lit(0)
    df = df.withColumn("_part", F.coalesce(part, F.lit(0)))
    tops = df.where(F.col(id_col).isNotNull()).groupBy("_part").agg(F.max(id_col).alias("top")).collect()
    tops = sorted((r["_part"], r["top"]) for r in tops)
    ends = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    rows = df.withColumn("_copy", F.lit(0))
    if ends:
        target = F.create_map(*(F.lit(x) for pair in ends.items() for x in pair))
        copies = df.where(F.col(id_col).isin(list(ends)))
        rows = rows.union(copies.withColumns({"_part": target[F.col(id_col)], "_copy": F.lit(1)}).select(rows.columns))
    order = Window.partitionBy("_part").orderBy("_copy", F.desc_nulls_last(id_col), tie)
    following = F.lead(F.struct(*columns)).over(order)
    rows = rows.withColumn("_next", following).where("_copy = 0")
    return rows.withColumns({f"next_{c}": F.col(f"_next.{c}") for c in columns}).drop("_part", "_copy", "_next")
