"""Best-fit packing with linear grouping.

1. Texts become token ids and are cut only where they exceed the capacity; each
   piece is a row of (document, piece, start, length, CRC of its ids).
2. Only the counts by length (at most ``capacity`` numbers) reach the driver. The
   large lengths are split into groups of equal cardinality and rounded up to the
   longest of their group. Few-size configurations are then optimised: for the
   largest size left, a subset-sum search finds the set of rounded sizes that
   fills a sequence best, and it is used as often as the demand allows.
3. The actual pieces take the places: pieces are numbered within their group, and
   a range of numbers belongs to a place of a run of equal sequences.
4. The room that rounding left, again only counted by size, takes the small pieces
   best-fit, longest first; new sequences are opened when nothing fits.

Every plan row stands for many pieces, so the plan's size depends on the capacity
and the number of groups, not on the corpus. Numbering is spread over buckets, so
one length may hold most pieces.

Defined results. Null or empty text: the end id alone, one piece of length 1.
Repeated rows each get their own pieces and places (the pairs of document and
piece then repeat). Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardfold.llm.common import slices, small_batches, store

CAPACITY = 2048
GROUPS = 1024
#: Pieces of up to this many tokens are small.
SMALL = CAPACITY // 8
SLICE_BYTES = 2 << 20
#: Pieces a worker remembers.
MEMORY = 240_000

#: What the tokenizer takes as one piece before merging (fixed by its file).
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LATIN = regex.compile(r"[\t\n\r -~¡-įı-ɏ]*")


#: Texts cut into pieces by array operations: Latin letters, no apostrophe (contractions),
#: no ``<`` (special tokens), no rare white space; lower case keeps their length and NFC.
_SIMPLE = re.compile(r"[\t\n\r -&(-;=-~¡-įı-ɏ]*")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _kind(char: str) -> int:
    group = unicodedata.category(char)[0]
    return _SPACE if char.isspace() else _LETTER if group == "L" else _DIGIT if group == "N" else _OTHER


class WordTokenizer:
    """Ids of a tokenizer that drops white space and merges within pieces only.

    A piece is a run of letters, a digit, or a run of other signs. Simple texts are
    cut into pieces by array operations (equal pieces are found by a 64-bit hash),
    other texts by the pattern. A piece's last id is a word-end token, so all new
    pieces of a slice are encoded in one call. Texts with special tokens or marks
    that the tokenizer normalises go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tool.get_vocab_size(), bool)
        for word, i in self.tool.get_vocab(with_added_tokens=False).items():
            self.ends[i] = word.endswith("</w>")
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kinds = np.array([_kind(chr(c)) for c in range(0x250)], np.uint8)
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _plain(self, text: str) -> bytes:
        return array("I", self.tool.encode(text, add_special_tokens=False).ids).tobytes()

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.pieces) > MEMORY // 2:
            # Rare pieces fall out with the older half; the others come back from it.
            self.older, self.pieces = self.pieces, {}
        known, older = self.pieces, self.older
        missing = [p for p in pieces if p not in known]
        known.update((p, older[p]) for p in missing if p in older)
        new = list(dict.fromkeys(p for p in missing if p not in known))
        if new:
            ids = self.tool.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.uint32)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) == len(new):
                raw = ids.tobytes()
                known.update((p, raw[a:b]) for p, a, b in zip(new, [0, *cuts], cuts))
            else:
                known.update((p, self._plain(p)) for p in new)
        return list(map(known.__getitem__, pieces))

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            base = 0x9E3779B97F4A7C15
            for name, factor in (("power", base), ("inverse", pow(base, -1, 1 << 64))):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _simple(self, texts: list[str]) -> list[bytes]:
        joined = "\n".join(texts).lower() + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kinds[codes]
        edge = kind[1:] != kind[:-1]
        digit = kind == _DIGIT
        solid = kind != _SPACE
        starts = np.flatnonzero(solid & np.concatenate([[True], edge | digit[1:]]))
        stops = np.flatnonzero(solid & np.concatenate([edge | digit[:-1], [True]])) + 1
        if not len(starts):
            return [b""] * len(texts)
        self._powers(len(codes) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * self.power[: len(codes)], dtype=np.uint64)])
        keys = (sums[stops] - sums[starts]) * self.inverse[starts]
        keys ^= keys >> np.uint64(29)
        keys = keys * np.uint64(0xBF58476D1CE4E5B9) + (stops - starts).astype(np.uint64)
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        ids = self._ids([joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())])
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cut = np.searchsorted(starts, begin).tolist()
        get = ids.__getitem__
        which = which.tolist()
        return [b"".join(map(get, which[a:b])) for a, b in zip(cut, cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(texts)
        simple = []
        for i, text in enumerate(texts):
            if _SIMPLE.fullmatch(text):
                simple.append(i)
            elif "<|" not in text and _LATIN.fullmatch(text) and unicodedata.is_normalized("NFC", text):
                out[i] = b"".join(self._ids(_PIECE.findall(text.lower())))
            else:
                out[i] = self._plain(text)
        for i, ids in zip(simple, self._simple([texts[i] for i in simple])):
            out[i] = ids
        return out


_TOOLS: dict[str, WordTokenizer] = {}


def _pieces(path: str, capacity: int, end: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _TOOLS.setdefault(path, None) or WordTokenizer(path)
        _TOOLS[path] = tool
        step = 4 * capacity
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = []
                for doc, ids in zip(part.column("id").to_pylist(), tool.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        own = ids[at : at + step]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own)))
                columns = list(zip(*rows))
                kinds = (part.schema.field("id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def tokenized_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the token pieces of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = _pieces(path, capacity, array("I", [end_id]).tobytes())
    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


# --- plans, on counts by length -------------------------------------------------
def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, int]]:
    """(rounded size, demand), largest first: groups of equal cardinality.

    A length is never divided, so a frequent one may be a group of its own.
    """
    total, out, held, done = sum(counts.values()), [], 0, 0
    top = None
    for length in sorted(counts, reverse=True):
        top = top or length
        held += counts[length]
        if (done + held) * groups >= (len(out) + 1) * total:
            out.append((top, held))
            done, held, top = done + held, 0, None
    if held:
        out.append((top, held))
    return out


def _best_fill(sizes: list[int], left: list[int], first: int, capacity: int) -> list[int]:
    """How many of each size fill a sequence best, with one of ``first`` in it.

    Subset sums over the sizes, largest first; of equal sums the one with larger
    sizes wins.
    """
    room = capacity - sizes[first]
    came: list[tuple[int, int] | None] = [None] * (room + 1)  # (size, times) that reached a sum
    came[0] = (-1, 0)
    reached = [0]
    for i in range(first, len(sizes)):
        have = left[i] - (i == first)
        size = sizes[i]
        if have <= 0 or size > room:
            continue
        fresh = []
        for base in reached:
            for k in range(1, min(have, (room - base) // size) + 1):
                if came[base + k * size] is None:
                    came[base + k * size] = (i, k)
                    fresh.append(base + k * size)
        reached += fresh
        if came[room] is not None:
            break
    take, at = [0] * len(sizes), max(reached)
    while at:
        i, k = came[at]
        take[i] += k
        at -= k * sizes[i]
    take[first] += 1
    return take


def configurations(demand: list[tuple[int, int]], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(sequences, {group: places})] covering the demand of every rounded size."""
    sizes, left, out = [s for s, _ in demand], [n for _, n in demand], []
    for first in range(len(sizes)):
        while left[first]:
            take = _best_fill(sizes, left, first, capacity)
            times = min(left[i] // k for i, k in enumerate(take) if k)
            for i, k in enumerate(take):
                left[i] -= k * times
            out.append((times, {i: k for i, k in enumerate(take) if k}))
    return out


def best_fit(rooms: dict[int, int], smalls: dict[int, int], capacity: int) -> list[tuple]:
    """Places for the small pieces: [(room class, first, count, per sequence, length, order)].

    ``rooms``: sequences by the room they have; class None is new sequences. A row
    says that the sequences numbered first .. first+count-1 of a class take ``per``
    pieces of ``length`` each. Longest first, each in the fullest room that takes it.
    """
    chunks = [[r, r, 0, n] for r, n in rooms.items() if r > 0]  # room now, class, first, count
    heap: dict[int, list[list]] = {}
    for c in chunks:
        heap.setdefault(c[0], []).append(c)
    opened, order, out = 0, 0, []
    for length in sorted(smalls, reverse=True):
        left = smalls[length]
        while left:
            fits = [r for r, own in heap.items() if r >= length and own]
            if not fits:
                per = max(1, capacity // length)
                count = max(1, left // per)
                per = min(per, left)
                heap.setdefault(capacity, []).append([capacity, None, opened, count])
                opened += count
                continue
            room = min(fits)
            _, kind, first, count = heap[room].pop()
            per = min(room // length, left)
            used = min(count, left // per)
            out.append((kind, first, used, per, length, order))
            order += 1
            left -= used * per
            heap.setdefault(room - per * length, []).append([room - per * length, kind, first, used])
            if used < count:
                heap[room].append([room, kind, first + used, count - used])
    return out


# --- numbering and places --------------------------------------------------------
def numbered(df: DataFrame, key: str, tie: list[str], name: str = "number") -> DataFrame:
    """``df`` with a gapless number from 0 within each key, spread over buckets."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*tie), F.lit(buckets)))
    counts = df.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*tie))
    df = df.withColumn("_row", inside).join(counts, [key, "_bucket"])
    return df.withColumn(name, F.col("_before") + F.col("_row") - 1).drop("_bucket", "_before", "_row")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _placed(items: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """Each numbered item with the plan row of its key that holds its number.

    Plan rows of a key are ranges in order of ``low``; the plan is bounded by the
    capacity and the groups, so it is sent to all tasks as one array a key.
    """
    held = plan.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("low", "high", "base", "sequences", "slot"))).alias("rows"))
    items = items.join(F.broadcast(held), key)
    spot = F.filter("rows", lambda r: (r["low"] <= F.col("number")) & (F.col("number") < r["high"]))[0]
    return items.withColumn("spot", spot).drop("rows")


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """``pieces`` with sequence_id and offset: places in sequences of ``capacity``."""
    spark = pieces.sparkSession
    tie = ["id", "piece", "ids_crc32"]
    with small_batches(pieces.sparkSession):
        pieces = store(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    large = {k: n for k, n in counts.items() if k > small}
    smalls = {k: n for k, n in counts.items() if k <= small}

    demand = linear_groups(large, groups)
    plan, base, taken = [], 0, [0] * len(demand)
    for times, take in configurations(demand, capacity):
        slot = 0
        for group, places in take.items():
            plan.append((group, taken[group], taken[group] + times * places, base, times, slot))
            taken[group] += times * places
            slot += places
        base += times
    tops = sorted((size for size, _ in demand), reverse=True)
    group = F.size(F.filter(F.array(*map(F.lit, tops)), lambda s: s >= F.col("length"))) - 1 if tops else F.lit(0)
    schema = "low bigint, high bigint, base bigint, sequences bigint, slot bigint"
    big = numbered(pieces.where(F.col("length") > small).withColumn("group", group), "group", tie)
    big = _placed(big, _table(spark, plan, f"`group` int, {schema}"), "group")
    at = F.col("number") - F.col("spot.low")
    big = big.select(
        *pieces.columns,
        (F.col("spot.base") + at % F.col("spot.sequences")).alias("sequence_id"),
        (F.col("spot.slot") + F.floor(at / F.col("spot.sequences"))).alias("slot"),
    )
    big = store(big, "large")

    rooms = big.groupBy("sequence_id").agg((capacity - F.sum("length")).alias("room"))
    rooms = store(numbered(rooms, "room", ["sequence_id"]), "rooms")
    room_counts = {r["room"]: r["n"] for r in rooms.groupBy("room").agg(F.count("*").alias("n")).collect()}
    fits = best_fit(room_counts, smalls, capacity)
    plan, taken = [], {}
    for kind, first, count, per, length, order in fits:
        low = taken.get(length, 0)
        taken[length] = low + count * per
        # new sequences are the class -1, numbered after all others
        plan.append((length, low, low + count * per, first, count, capacity + order * capacity, -1 if kind is None else kind))
    small_rows = numbered(pieces.where(F.col("length") <= small), "length", tie)
    schema = "low bigint, high bigint, base bigint, sequences bigint, slot bigint"
    rows = _table(spark, plan, f"length bigint, {schema}, room bigint")
    held = rows.groupBy("length").agg(F.collect_list(F.struct("low", "high", "base", "sequences", "slot", "room")).alias("rows"))
    small_rows = small_rows.join(F.broadcast(held), "length")
    spot = F.filter("rows", lambda r: (r["low"] <= F.col("number")) & (F.col("number") < r["high"]))[0]
    small_rows = small_rows.withColumn("spot", spot)
    at = F.col("number") - F.col("spot.low")
    small_rows = small_rows.select(
        *pieces.columns,
        F.col("spot.room").alias("room"),
        (F.col("spot.base") + at % F.col("spot.sequences")).alias("number"),
        (F.col("spot.slot") + F.floor(at / F.col("spot.sequences"))).alias("slot"),
    )
    fresh = small_rows.where("room < 0").withColumn("sequence_id", F.col("number") + base)
    filled = small_rows.where("room >= 0").join(rooms, ["room", "number"])
    columns = [*pieces.columns, "sequence_id", "slot"]
    out = big.select(columns).union(fresh.select(columns)).union(filled.select(columns))
    # At most ``capacity`` pieces share a sequence.
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")
