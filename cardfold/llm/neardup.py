"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass turns each text into its set of five-word shingles: the size, a key
   of the whole set, a MinHash signature and the keys of its bands.
2. Equal sets are one class, stood for by its smallest document id. Buckets are
   the representatives that share a band; buckets with equal members count once.
3. Every candidate is compared with the smallest id of its buckets: one pair each,
   so a tight group of n copies costs n comparisons. Buckets that then hold one
   component are done. In the others all members of different components are
   compared inside the tasks, most similar signatures first, and only links that
   join two components come out; large buckets are cut into blocks of bounded rows
   and bytes, and each pair of blocks is one unit of work.
4. A pair's signatures are compared batch by batch. With a uniform prior the
   posterior of the similarity after m of n equal hashes is Beta(m+1, n-m+1); the
   pair is dropped as soon as P(similarity >= threshold) < ``miss``.
5. Survivors are confirmed on the full shingle sets of both texts (64-bit hashes).
6. Links update the components (min-label propagation over written tables).

32 bands of 4 hashes miss a pair at similarity 0.75 with probability 5e-6.

Defined results. Null, empty or blank text: no shingles, linked with nothing.
Fewer than five words: the whole sequence is the one shingle. Rows without an id
are linked with nothing, get a null component and are kept. Ids are expected to
be unique; fully repeated rows share their id and their component, and all are
kept or dropped together. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterator
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cardfold.llm.common import byte_texts, slices, small, small_batches, store

SHINGLE = 5
HASHES = 128
BANDS = 32
BATCH = 32
MISS = 1e-5
SLICE_BYTES = 2 << 20

_rng = np.random.RandomState(20240229)
_MULT = _rng.randint(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.randint(0, 1 << 63, HASHES, np.uint64)
_STEP = _rng.randint(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    n = max(1, len(own) - size + 1)
    total = np.full(n, len(own) if len(own) < size else size, np.uint64)
    for i in range(min(size, len(own))):
        total += _mixed(word[i : i + n]) * _STEP[i]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(hashes), 1024):
        block = hashes[i : i + 1024, None] * _MULT
        block += _ADD
        block >>= np.uint64(32)
        np.minimum(out, block.min(axis=0), out=out)
    return out.astype(np.uint32)


def _band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.astype(np.uint64).reshape(BANDS, -1)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows.shape[1]):
        total = _mixed(total + rows[:, i] * _STEP[32 + i])
    return total.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            sizes, keys, sigs, bands = [], [], [], []
            for text in byte_texts(part.column("text")):
                hashes = shingle_hashes(text)
                sizes.append(len(hashes))
                if len(hashes):
                    sig = signature(hashes)
                    keys.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                    sigs.append(sig.tobytes())
                    bands.append(_band_keys(sig))
                else:
                    keys.append(None), sigs.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "set_key", "sig", "bands"],
            )


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest equal hashes of ``n`` with P(similarity >= threshold) >= miss.

    P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m).
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


class Bounds:
    """Sequential test of signature pairs, batch of hashes by batch."""

    def __init__(self, threshold: float, miss: float):
        self.least = [(n, least_matches(n, threshold, miss)) for n in range(BATCH, HASHES + 1, BATCH)]

    def test(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows that stay, and their equal hashes; ``one`` may be a single row."""
        alive, equal = np.arange(len(two)), np.zeros(len(two), np.int64)
        for n, least in self.least:
            left = one[n - BATCH : n] if one.ndim == 1 else one[alive, n - BATCH : n]
            equal[alive] += (left == two[alive, n - BATCH : n]).sum(axis=1)
            alive = alive[equal[alive] >= least]
        return alive, equal[alive]


class Sets:
    """Shingle hashes by key, rebuilt from the text when memory is short."""

    def __init__(self, limit: int = 16 << 20):
        self.held, self.size, self.limit = OrderedDict(), 0, limit

    def get(self, key, text: bytes) -> np.ndarray:
        if key in self.held:
            self.held.move_to_end(key)
        else:
            self.held[key] = shingle_hashes(text)
            self.size += self.held[key].nbytes
            while self.size > self.limit and len(self.held) > 2:
                self.size -= self.held.popitem(last=False)[1].nbytes
        return self.held[key]


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _bayes(threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(threshold, miss)
        for batch in batches:
            if batch.num_rows:
                alive, _ = bounds.test(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")))
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets()
        for batch in batches:
            for part in slices(batch, "text_b", SLICE_BYTES):
                columns = (part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
                keep = [
                    i
                    for i, (a, b, s, t) in enumerate(zip(*columns))
                    if _linked(sets.get(a, s.encode()), sets.get(b, t.encode()), percent)
                ]
                yield part.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _settle(rows: list[dict], bounds: Bounds, percent: int) -> list[tuple[int, int]]:
    """Links that join the components of one bucket; every pair of two components is tested.

    ``rows``: id, root, sig, text, side. Rows of side 0 and 1 are two blocks of a
    bucket and only tested across; side 2 is a block tested within.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    sizes = Counter(r["root"] for r in rows)
    rows = sorted(rows, key=lambda r: (sizes[r["root"]], r["root"], r["id"]))  # the largest component last
    sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(-1, HASHES)
    root = np.array([r["root"] for r in rows])
    side = np.array([r["side"] for r in rows])
    sets, links = Sets(), []
    for i, row in enumerate(rows):
        apart = np.flatnonzero((root[i + 1 :] != root[i]) & ((side[i + 1 :] != side[i]) | (side[i] == 2))) + i + 1
        if not len(apart):
            continue
        alive, equal = bounds.test(sig[i], sig[apart])
        for j in apart[alive[np.argsort(-equal, kind="stable")]]:
            other = rows[j]
            if find(row["root"]) == find(other["root"]):
                continue
            if _linked(sets.get(row["id"], row["text"].encode()), sets.get(other["id"], other["text"].encode()), percent):
                parent[find(row["root"])] = find(other["root"])
                links.append((row["id"], other["id"]))
    return links


def _settle_buckets(threshold: float, miss: float, percent: int):
    """Buckets come as runs of rows of equal (key, pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, held, last = Bounds(threshold, miss), [], None

        def out(links):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for row in part.to_pylist():
                    if (row["key"], row["pair"]) != last:
                        if held:
                            yield out(_settle(held, bounds, percent))
                        held, last = [], (row["key"], row["pair"])
                    held.append(row)
        if held:
            yield out(_settle(held, bounds, percent))

    return run


def _components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node reached.

    Every round each node takes the smallest label around it and then the label
    of its label, so a path of n nodes ends in about log(n) rounds.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = store(both.distinct(), "links")
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = store(labels, "labels")
    while True:
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("root").alias("near"))
        hop = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = labels.join(near, "node").join(hop, "root")
        new = new.select("node", F.least("root", "near", "next").alias("root"), F.col("root").alias("old"))
        new = store(new, "labels")
        labels = new.select("node", "root")
        if new.where("root != old").isEmpty():
            return labels


def _verified(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, miss: float) -> DataFrame:
    """The linked ones of ``pairs`` (a, b): by signatures first, then on the full sets."""
    sides = [("a", "sig_a", "text_a"), ("b", "sig_b", "text_b")]
    for key, sig, _ in sides:
        pairs = pairs.join(sigs.select(F.col("id").alias(key), F.col("sig").alias(sig)), key)
    likely = pairs.mapInArrow(_bayes(percent / 100, miss), "a bigint, b bigint")
    for key, _, text in sides:
        likely = likely.join(texts.select(F.col("id").alias(key), F.col("text").alias(text)), key)
    return store(likely.mapInArrow(_confirm(percent), "a bigint, b bigint"), "found")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def link_classes(
    reps: DataFrame,
    texts: DataFrame,
    percent: int = 75,
    miss: float = MISS,
    block_rows: int = 1000,
    block_bytes: int = 4 << 20,
) -> DataFrame | None:
    """(node, root) for the representatives linked with another one; None without any.

    ``reps``: id, sig, bands of each class; ``texts``: id, text.
    """
    keys = reps.select("id", F.explode("bands").alias("key")).repartition("key")
    spread = F.xxhash64("id")
    shared = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(spread).alias("x"), F.sum(F.shiftright(spread, 8)).alias("y"), F.min("id").alias("m")
    )
    once = shared.where("n > 1").groupBy("n", "x", "y", "m").agg(F.min("key").alias("key")).select("key")
    members = store(keys.join(once, "key"), "buckets")
    ids = small(store(members.select("id").distinct(), "candidates"))
    sigs = store(reps.select("id", "sig").join(ids, "id", "left_semi"), "signatures")
    texts = texts.join(ids, "id", "left_semi").dropDuplicates(["id"])
    texts = store(texts.withColumn("size", F.octet_length("text")), "texts")

    # Every candidate against the smallest id of all its buckets: at most one pair each.
    lead = members.groupBy("key").agg(F.min("id").alias("center"))
    first = members.join(lead, "key").groupBy("id").agg(F.min("center").alias("center")).where("id != center")
    links = _verified(first.select(*_ordered("id", "center")), sigs, texts, percent, miss)
    roots = None if links.isEmpty() else _components(links)

    # Buckets that still hold several components: every pair across them.
    members = members.select("key", "id")
    if roots is None:
        members = members.withColumn("root", F.col("id"))
    else:
        members = members.join(roots.withColumnRenamed("node", "id"), "id", "left")
        members = members.select("key", "id", F.coalesce("root", "id").alias("root"))
    parts = F.ceil(F.greatest(F.count("*") / block_rows, F.sum("size") / block_bytes)).cast("int")
    sized = members.join(texts.select("id", "size"), "id")
    open_keys = sized.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), parts.alias("parts"))
    # Only members of open buckets get their text and signature.
    members = members.join(open_keys.where("low < high").select("key", "parts"), "key")
    members = members.join(texts.select("id", "text"), "id").join(sigs, "id")
    own = F.pmod(F.xxhash64("id"), "parts").cast("int")
    # A block meets every block of its bucket once: pair (i, i) is a block tested within.
    members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    members = members.select("key", pair.alias("pair"), side.alias("side"), "id", "root", "sig", "text")
    members = members.repartition("key", "pair").sortWithinPartitions("key", "pair")
    found = store(members.mapInArrow(_settle_buckets(percent / 100, miss, percent), "a bigint, b bigint"), "found")
    if found.isEmpty():
        return roots
    if roots is not None:  # earlier components stay together
        found = found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return _components(found)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, miss: float = MISS
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if 100 * intersection >= percent * union of their
    shingle sets; a component is named after its smallest id, which is kept.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = "id bigint, n_shingles bigint, set_key binary, sig binary, bands array<bigint>"
    with small_batches(docs.sparkSession):
        sketches = store(texts.mapInArrow(_sketch, kinds), "sketches")
        linked = sketches.where("id is not null and set_key is not null")
        classes = store(linked.groupBy("set_key").agg(F.min("id").alias("rep")), "classes")
        reps = linked.select("id", "sig", "bands").join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
        roots = link_classes(reps, texts, percent, miss)
    named = classes.withColumn("component_id", F.col("rep"))
    if roots is not None:
        named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        named = named.withColumn("component_id", F.coalesce("root", "rep"))
    out = sketches.select("id", "n_shingles", "set_key").join(named.select("set_key", "component_id"), "set_key", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document stands for its component."""
    judged = near_duplicates(docs, id_col, **options)
    gone = judged.where(~F.col("kept")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")
