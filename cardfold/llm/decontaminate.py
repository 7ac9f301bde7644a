"""Benchmark decontamination with suffix arrays over the training texts.

Each slice of training documents becomes a shard: its words are numbered by the
benchmark's vocabulary, words the benchmark does not know end a suffix, and the
suffixes that are left are sorted (prefix doubling). Every test suffix is then
binary-searched in the shard: the interval of its window gives all verbatim
occurrences, the nearest suffixes give the longest match of each document.

The benchmark is the stated query set. It is sent to the tasks in blocks of
``block_bytes`` of text; each block is one pass over the documents, chained in
one job, without a shuffle.

Defined results. Null or empty text: no words, no hits, clean. Benchmark rows
whose text has no words never match; rows without an id count as id ``''``.
Items shorter than the window match as a whole. Repeated items each count with
their own id; one id is counted once. A document repeated in the input is judged
row by row. Extra columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardfold.llm.common import byte_texts, free_name, ranges, slices

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
#: Maximal runs of digits, small letters and non-ASCII, on lower-cased UTF-8.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

FOUND = (
    "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<string>,"
    "longest:bigint,longest_start:bigint,longest_item:string,longest_item_start:bigint>"
)
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int64()),
        ("longest_start", pa.int64()),
        ("longest_item", pa.string()),
        ("longest_item_start", pa.int64()),
    ]
)


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class TestBlock:
    """One block of test items: their words, and their windows as classes of equal words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        vocab: dict[bytes, int] = {}
        parts, self.starts, self.names, at = [], [], [], 0
        classes: dict[tuple, int] = {}
        owners: list[set[str]] = []
        self.first, self.length = [], []  # of each class: a place in self.words, words
        for name, text in items:
            own = words(text)
            if not own:
                continue
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in own]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                key = tuple(ids[i : i + size])
                c = classes.setdefault(key, len(classes))
                if c == len(owners):
                    owners.append(set())
                    self.first.append(at + i)
                    self.length.append(size)
                owners[c].add(name)
            self.starts.append(at)
            self.names.append(name)
            parts.append(np.array([*ids, 0], np.int32))
            at += len(ids) + 1
        self.vocab = vocab
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.longest_item = max((len(p) - 1 for p in parts), default=0)
        self.first, self.length = np.array(self.first, np.int64), np.array(self.length, np.int64)
        self.starts = np.array(self.starts, np.int64)
        sets: dict[frozenset, int] = {}  # classes of the same items share a set
        self.owner_set = np.array([sets.setdefault(frozenset(o), len(sets)) for o in owners], np.int64)
        self.owner_sets = [sorted(s) for s in sets]


class Suffixes:
    """Sorted suffixes of a number sequence in which 0 ends a suffix.

    ``levels[k]`` ranks the first 2**k numbers of every suffix.
    """

    def __init__(self, numbers: np.ndarray, deepest: int):
        n = len(numbers)
        ends = np.flatnonzero(numbers == 0)
        stop = np.append(ends, n)[np.searchsorted(ends, np.arange(n))]
        self.left = stop - np.arange(n)  # numbers up to the end of the suffix
        self.levels = [numbers.astype(np.int64)]
        while 1 << (len(self.levels) - 1) < deepest:
            self.levels.append(self._pair(len(self.levels) - 1, 1 << (len(self.levels) - 1)))

    def _second(self, k: int, shift: int, at: np.ndarray) -> np.ndarray:
        inside = self.left[at] > shift
        return np.where(inside, self.levels[k][np.where(inside, at + shift, 0)], 0)

    def _key(self, k: int, shift: int, at: np.ndarray) -> np.ndarray:
        own = self.levels[k]
        return own[at] * (int(own.max(initial=0)) + 1) + self._second(k, shift, at)

    def _pair(self, k: int, shift: int) -> np.ndarray:
        at = np.flatnonzero(self.left > 0)
        out = np.zeros(len(self.left), np.int64)
        if len(at):
            out[at] = np.unique(self._key(k, shift, at), return_inverse=True)[1] + 1
        return out

    def prefix(self, size: int, at: np.ndarray) -> np.ndarray:
        """A number for the first ``size`` numbers of the suffixes, in suffix order."""
        k = size.bit_length() - 1
        return self._key(k, size - (1 << k), at)

    def sort(self, at: np.ndarray) -> np.ndarray:
        return at[np.argsort(self.levels[-1][at], kind="stable")]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix, pair by pair."""
        most = np.minimum(self.left[a], self.left[b])
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            more = got < most
            x, y = np.where(more, a + got, 0), np.where(more, b + got, 0)
            same = more & (self.levels[k][x] == self.levels[k][y])
            got += np.where(same, 1 << k, 0)
        return np.minimum(got, most)


def _search(texts: list[bytes], block: TestBlock):
    """Yield per document (n_words, hit spans, owner sets, longest match)."""
    get, ids, sizes = block.vocab.get, [], []
    for text in texts:
        own = words(text)
        ids.append(np.fromiter(map(get, own, repeat(0)), np.int32, len(own)))
        ids.append(np.zeros(1, np.int32))
        sizes.append(len(own))
    shard = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    begin = np.cumsum([0, *(s + 1 for s in sizes)])
    nothing = ([], [], (0, None, None, None))
    known = np.diff(np.concatenate([[0], (shard > 0).view(np.int8), [0]]))
    run, stop = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
    least = int(block.length.min(initial=1 << 40))
    keep = stop - run >= least
    run, size = run[keep], (stop - run)[keep]
    if not len(run):
        return [(s, *nothing) for s in sizes]
    place = ranges(run, size + 1)  # each run with the word that ends it
    n = len(place)
    suffixes = Suffixes(np.concatenate([np.where(shard[place] > 0, shard[place], 0), block.words]), block.longest_item)
    order = suffixes.sort(np.flatnonzero(suffixes.left[:n] >= least))
    spots, kinds, spans = [], [], []
    for length in np.unique(block.length):
        tests = np.flatnonzero(block.length == length)
        sought = suffixes.prefix(int(length), block.first[tests] + n)
        sorted_keys = suffixes.prefix(int(length), order)
        low = np.searchsorted(sorted_keys, sought, "left")
        many = np.searchsorted(sorted_keys, sought, "right") - low
        spots.append(order[ranges(low, many)])
        kinds.append(np.repeat(tests, many))
        spans.append(np.full(len(spots[-1]), length, np.int64))
    spot, kind, span = map(np.concatenate, (spots, kinds, spans))
    if not len(spot):
        return [(s, *nothing) for s in sizes]

    at = place[spot]
    change = np.zeros(len(shard) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + span, -1)
    covered = np.diff(np.concatenate([[0], (np.cumsum(change)[:-1] > 0).view(np.int8), [0]]))
    hit_run, hit_stop = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)

    doc = np.searchsorted(begin, at, "right") - 1
    owners: dict[int, set[int]] = {}
    for pair in np.unique(doc * len(block.owner_sets) + block.owner_set[kind]).tolist():
        owners.setdefault(pair // len(block.owner_sets), set()).add(pair % len(block.owner_sets))

    tests = suffixes.sort(np.flatnonzero(suffixes.left[n:] > 0) + n)
    near = np.searchsorted(suffixes.levels[-1][tests], suffixes.levels[-1][spot])
    sides = [tests[np.clip(near + d, 0, len(tests) - 1)] for d in (-1, 0)]
    both = [suffixes.common(spot, s) for s in sides]
    right = both[1] >= both[0]
    length, partner = np.where(right, both[1], both[0]), np.where(right, sides[1], sides[0]) - n
    best: dict[int, tuple] = {}
    for i in np.lexsort((at, -length, doc)):
        d = int(doc[i])
        if d not in best:
            item = int(np.searchsorted(block.starts, partner[i], "right")) - 1
            best[d] = (int(length[i]), int(at[i] - begin[d]), block.names[item], int(partner[i] - block.starts[item]))

    out, hit_doc = [], np.searchsorted(begin, hit_run, "right") - 1
    cut = np.searchsorted(hit_doc, np.arange(len(sizes) + 1))
    for d, s in enumerate(sizes):
        own = [(int(a - begin[d]), int(b - begin[d])) for a, b in zip(hit_run[cut[d] : cut[d + 1]], hit_stop[cut[d] : cut[d + 1]])]
        names = sorted(set().union(*(block.owner_sets[o] for o in owners.get(d, ()))))
        out.append((s, own, names, best.get(d, nothing[2])))
    return out


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(block, text_col: str, found_col: str, first: bool, keep_text: bool, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: TestBlock = block.value
        for batch in batches:
            for part in slices(batch, text_col, shard_bytes):
                rows = _search(byte_texts(part.column(text_col)), own)
                before = repeat(None) if first else part.column(found_col).to_pylist()
                found = []
                for (n, spans, items, best), old in zip(rows, before):
                    if old and old["items"]:
                        spans = _merge([*spans, *((s["start"], s["stop"]) for s in old["spans"])])
                        items = sorted({*items, *old["items"]})
                        if old["longest"] >= best[0]:
                            best = (old["longest"], old["longest_start"], old["longest_item"], old["longest_item_start"])
                    found.append(
                        {
                            "n_words": n,
                            "spans": [{"start": a, "stop": b} for a, b in spans],
                            "items": items,
                            "longest": best[0],
                            "longest_start": best[1],
                            "longest_item": best[2],
                            "longest_item_start": best[3],
                        }
                    )
                names = [c for c in part.schema.names if c != found_col and (keep_text or c != text_col)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(found, _FOUND_ARROW)], [*names, found_col]
                )

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col)).where(
        F.col(text_col).isNotNull()
    )
    held, size = [], 0
    for name, text in rows.toLocalIterator():
        raw = text.encode()
        if held and size + len(raw) > block_bytes:
            yield TestBlock(held, window)
            held, size = [], 0
        held.append((name, raw))
        size += len(raw)
    yield TestBlock(held, window)


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
    found_col: str = "found",
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with a struct of the verbatim matches of each row.

    The struct holds the word count, the spans of hit words, the ids of the
    items with a matching window, and the longest match with its places.
    ``keep_text=False`` leaves the text out of the result.
    """
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, item_col, item_text_col, window, block_bytes))
    for i, block in enumerate(blocks):
        stays = keep_text or i < len(blocks) - 1
        kept = [f for f in docs.schema.fields if f.name != found_col and (stays or f.name != text_col)]
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{found_col}` {FOUND}"])
        sent = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_pass(sent, text_col, found_col, i == 0, stays, shard_bytes), schema)
    return docs


def n_hit(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])


def contaminated(found: Column, one_in: int = 20) -> Column:
    """At least one word in ``one_in`` is hit, and one at all."""
    return (n_hit(found) > 0) & (n_hit(found) * one_in >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    name = free_name(docs, "found")
    found = find_matches(docs, benchmark, text_col=text_col, found_col=name, **options)
    return found.where(~contaminated(F.col(name))).drop(name)
