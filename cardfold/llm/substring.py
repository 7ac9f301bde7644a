"""Substring deduplication with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of 7 words. A repeat
of 13 words holds a whole block of either copy, so it is found by probing the
block index with every rolling window of 7 words; around each hit the windows of
13 words are compared, and overlapping repeated windows join to maximal repeats.

The data moves between chunks of documents (a few MB of text each) as sorted hash
lists, not as rows:

1. Each chunk sends its distinct rolling keys, marked where a block has the key,
   to the owner of the key's range; the owner answers with one bit a key: shared
   with another chunk, or not.
2. Each chunk extends its shared anchors to windows of 13 words and sends their
   keys (96 bits) with the smallest document id that it has for them.
3. The owner of a window answers chunks that do not have the smallest id.
4. Each chunk removes the words of every window that starts in a smaller document.

A key is sent once a chunk however often it occurs, so a passage in a third of all
documents costs one entry a chunk, and no pairs are made. The chunks' texts are
shuffled once; all steps read the same exchange.

Defined results. Words are runs of anything but ASCII white space, unchanged.
Null or empty text: no words. Documents of equal id are never repeats of each
other. Rows without an id count as having the largest one. Windows are judged on
the input. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cardfold.llm.common import byte_texts

WINDOW = 13
#: Twice the block less one is at most the window: each window holds a whole block.
BLOCK = (WINDOW + 1) // 2
CHUNK_BYTES = 4 << 20
_LAST = (1 << 63) - 1

_rng = np.random.RandomState(7919)
_FACTORS = _rng.randint(0, 1 << 63, (3, WINDOW), np.uint64) * np.uint64(2) + np.uint64(1)


class Chunk:
    """The words of a chunk's documents in a row, as hashes."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray):
        self.ids = ids.fill_null(_LAST).to_numpy()
        self.words = [t.split() for t in byte_texts(texts.combine_chunks())]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        digest = xxhash.xxh3_64_intdigest
        parts = [np.fromiter(map(digest, w), np.uint64, len(w)) for w in self.words]
        self.hashes = np.concatenate([*parts, np.zeros(0, np.uint64)])
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.left = np.repeat(self.begin[1:], sizes) - np.arange(len(self.hashes))  # words to the end

    def keys(self, size: int, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all runs of ``size`` words within a document, and their hashes."""
        n = max(0, len(self.hashes) - size + 1)
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += self.hashes[j : j + n] * _FACTORS[which, j]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        at = np.flatnonzero(self.left[:n] >= size)
        return at, total[at]


class Probes:
    """The distinct rolling keys of a chunk and where they stand."""

    def __init__(self, chunk: Chunk):
        self.at, keys = chunk.keys(BLOCK, 0)
        self.keys, self.which = np.unique(keys, return_inverse=True)
        doc = chunk.doc[self.at]
        block = (self.at - chunk.begin[doc]) % BLOCK == 0
        self.block = np.zeros(len(self.keys), bool)
        self.block[self.which[block]] = True
        low, high = np.full(len(self.keys), _LAST), np.zeros(len(self.keys), np.int64)
        np.minimum.at(low, self.which, doc)
        np.maximum.at(high, self.which, doc)
        self.shared = self.block & (low < high)  # within the chunk

    def windows(self, chunk: Chunk, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows of a document around an anchor that is shared."""
        hit = self.at[shared[self.which]]
        change = np.zeros(len(chunk.hashes) + 1, np.int32)
        low = np.maximum(hit - (WINDOW - BLOCK), chunk.begin[chunk.doc[hit]])
        np.add.at(change, low, 1)
        np.add.at(change, hit + 1, -1)
        return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (chunk.left >= WINDOW))


def _owned(keys: np.ndarray, bits: int) -> np.ndarray:
    """Cuts of sorted keys by owner, the top ``bits`` bits."""
    if not bits:
        return np.array([0, len(keys)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


_PROBE = pa.schema([("owner", pa.int32()), ("chunk", pa.int64()), ("steps", pa.binary()), ("high", pa.binary()), ("block", pa.binary())])
_BITS = pa.schema([("chunk", pa.int64()), ("owner", pa.int32()), ("bits", pa.binary())])
_WINDOWS = pa.schema([("owner", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("more", pa.binary()), ("ids", pa.binary())])
_SMALLER = pa.schema([("chunk", pa.int64()), ("keys", pa.binary()), ("more", pa.binary()), ("ids", pa.binary())])
_KEPT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.string())])


def _sql(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names.get(f.type, 'array<struct<start:bigint,stop:bigint>>')}" for f in schema)


def _probe(bits: int):
    def run(docs: pa.Table) -> pa.Table:
        number = docs.column("chunk")[0].as_py()
        own = Probes(Chunk(docs.column("id"), docs.column("text")))
        cuts, rows = _owned(own.keys, bits), []
        for owner in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[owner], cuts[owner + 1])
            # The 32 bits after the owner's tell keys apart well enough for a bit that
            # only opens the exact comparison; their steps compress.
            short = ((own.keys[part] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
            steps = np.diff(short, prepend=np.uint32(0))
            low, high = (steps & 0xFFFF).astype(np.uint16), (steps >> 16).astype(np.uint16)
            rows.append((owner, number, low.tobytes(), high.tobytes(), np.packbits(own.block[part]).tobytes()))
        return _table(rows, _PROBE)

    return run


def _answer(probes: pa.Table) -> pa.Table:
    """A bit for each key that another chunk has too, if any of them has a block of it."""
    keys, blocks, sizes = [], [], []
    for low, high, block in zip(*(probes.column(c).to_pylist() for c in ("steps", "high", "block"))):
        steps = np.frombuffer(low, np.uint16).astype(np.uint32) | (np.frombuffer(high, np.uint16).astype(np.uint32) << 16)
        keys.append(np.cumsum(steps, dtype=np.uint32))
        blocks.append(np.unpackbits(np.frombuffer(block, np.uint8), count=len(steps)))
        sizes.append(len(steps))
    every = np.concatenate(keys)
    source = np.repeat(np.arange(len(sizes)), sizes)
    _, which = np.unique(every, return_inverse=True)
    n = int(which.max()) + 1
    block = np.bincount(which, np.concatenate(blocks), n) > 0
    low, high = np.full(n, _LAST), np.zeros(n, np.int64)
    np.minimum.at(low, which, source)
    np.maximum.at(high, which, source)
    shared = (block & (low < high))[which]
    rows, ends = [], np.cumsum(sizes)
    for chunk, owner, size, end in zip(probes.column("chunk").to_pylist(), probes.column("owner").to_pylist(), sizes, ends):
        own = shared[end - size : end]
        if own.any():
            rows.append((chunk, owner, np.packbits(own).tobytes()))
    return _table(rows, _BITS)


def _smallest(chunk: Chunk, starts: np.ndarray, at: np.ndarray, one: np.ndarray, two: np.ndarray):
    """Sorted distinct window keys of ``starts`` and the smallest id of each."""
    spot = np.searchsorted(at, starts)
    keys, more, ids = one[spot], (two[spot] >> np.uint64(32)).astype(np.uint32), chunk.ids[chunk.doc[starts]]
    order = np.lexsort((ids, more, keys))
    keys, more, ids = keys[order], more[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])
    return keys[first], more[first], ids[first]


def _extend(bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _WINDOWS)
        number = docs.column("chunk")[0].as_py()
        chunk = Chunk(docs.column("id"), docs.column("text"))
        probes = Probes(chunk)
        shared, cuts = probes.shared.copy(), _owned(probes.keys, bits)
        for owner, own in zip(answers.column("owner").to_pylist(), answers.column("bits").to_pylist()):
            a, b = cuts[owner], cuts[owner + 1]
            shared[a:b] |= np.unpackbits(np.frombuffer(own, np.uint8), count=b - a).astype(bool)
        starts = probes.windows(chunk, shared)
        at, one = chunk.keys(WINDOW, 1)
        _, two = chunk.keys(WINDOW, 2)
        keys, more, ids = _smallest(chunk, starts, at, one, two)
        cuts = _owned(keys, bits)
        rows = []
        for owner in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[owner], cuts[owner + 1])
            rows.append((owner, number, keys[part].tobytes(), more[part].tobytes(), ids[part].tobytes()))
        return _table(rows, _WINDOWS)

    return run


_NUMBERS = (("keys", np.uint64), ("more", np.uint32), ("ids", np.int64))


def _settle(windows: pa.Table) -> pa.Table:
    """To each chunk, the windows that another one has with a smaller id."""
    blobs = {c: [np.frombuffer(b, kind) for b in windows.column(c).to_pylist()] for c, kind in _NUMBERS}
    sizes = [len(b) for b in blobs["keys"]]
    keys, more, ids = (np.concatenate(blobs[c]) for c, _ in _NUMBERS)
    order = np.lexsort((ids, more, keys))
    first = np.ones(len(keys), bool)
    first[1:] = (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])
    least = np.empty(len(keys), np.int64)
    least[order] = ids[order][first][np.cumsum(first) - 1]
    rows, ends = [], np.cumsum(sizes)
    for chunk, size, end in zip(windows.column("chunk").to_pylist(), sizes, ends):
        part = slice(end - size, end)
        low = least[part] < ids[part]
        if low.any():
            rows.append((chunk, keys[part][low].tobytes(), more[part][low].tobytes(), least[part][low].tobytes()))
    return _table(rows, _SMALLER)


def _remove(docs: pa.Table, smaller: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _table([], _KEPT)
    chunk = Chunk(docs.column("id"), docs.column("text"))
    probes = Probes(chunk)
    at, one = chunk.keys(WINDOW, 1)
    _, two = chunk.keys(WINDOW, 2)
    more = (two >> np.uint64(32)).astype(np.uint32)
    doc_id = chunk.ids[chunk.doc[at]]
    lists = [_smallest(chunk, probes.windows(chunk, probes.shared), at, one, two)]
    blobs = [[np.frombuffer(b, kind) for b in smaller.column(c).to_pylist()] for c, kind in _NUMBERS]
    if smaller.num_rows:
        k, m, i = map(np.concatenate, blobs)
        order = np.lexsort((m, k))
        lists.append((k[order], m[order], i[order]))
    gone = np.zeros(len(at), bool)
    for k, m, i in lists:
        if not len(k):
            continue
        # Of equal first parts the second decides; runs of them are next to never longer than one.
        spot = np.searchsorted(k, one)
        while True:
            inside = spot < len(k)
            safe = np.where(inside, spot, 0)
            same = inside & (k[safe] == one)
            other = same & (m[safe] != more)
            if not other.any():
                break
            spot = spot + other
        gone |= same & (i[safe] < doc_id)
    change = np.zeros(len(chunk.hashes) + 1, np.int32)
    np.add.at(change, at[gone], 1)
    np.add.at(change, at[gone] + WINDOW, -1)
    cover = np.cumsum(change[:-1]) > 0
    rows = []
    for d, words in enumerate(chunk.words):
        own = cover[chunk.begin[d] : chunk.begin[d + 1]]
        spans = []
        if own.any():
            edge = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
            spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
            kept, last = [], 0
            for a, b in spans:
                kept += words[last:a]
                last = b
            words = kept + words[last:]
        rows.append((docs.column("id")[d].as_py(), len(own), [{"start": a, "stop": b} for a, b in spans], b" ".join(words).decode()))
    return _table(rows, _KEPT)


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(id, n_words, spans, kept): the removed spans of words, and the words left, joined by blanks."""
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    chunks = max(1, -(-total // chunk_bytes))
    bits = (chunks - 1).bit_length()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk")
    # Every step reads this one exchange.
    dealt = rows.select(chunk, "id", "text").repartition("chunk")
    probes = dealt.groupBy("chunk").applyInArrow(_probe(bits), _sql(_PROBE))
    answers = probes.groupBy("owner").applyInArrow(_answer, _sql(_BITS))
    windows = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_extend(bits), _sql(_WINDOWS))
    smaller = windows.groupBy("owner").applyInArrow(_settle, _sql(_SMALLER))
    return dealt.groupBy("chunk").cogroup(smaller.groupBy("chunk")).applyInArrow(_remove, _sql(_KEPT))
