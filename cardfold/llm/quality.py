"""Document quality with supervised subword embeddings.

Model. Every lower-cased word ``[^\\W_]+`` of a text is a feature, and so is each
character n-gram (3 to 5) of ``<word>``; all are hashed into ``buckets`` rows of
an embedding table E (``dim`` columns); n-grams are hashed with numpy over the
code points of all words of a batch at once. A document's vector is the mean of the
rows of all its features (each word token adds its word and n-gram rows); a
two-class softmax over W·h + b gives the score, the probability of label 1.

Training: stochastic gradient descent in numpy, distributed by parameter
averaging. The labelled examples (a bounded sample of ``examples`` rows, chosen
by a hash of the id, a documented parameter) are hashed into features once in
tasks and stored; each epoch every one of ``workers`` tasks runs SGD over its
share from the current model, returns the rows it changed, and the driver
averages them into the next model. The learning rate falls linearly to zero; an
embedding row's step is scaled by the number of the text's rows, so the mean
vector of a long text moves as fast as that of a short one.
Scoring reads every whole text of every row, in Arrow slices of bounded bytes.

Defined results. Null or empty text: the softmax of the bias alone. Labels,
language, source and id never enter a score. Without labelled rows the model
stays at its start (score 0.5). Repeated rows get equal scores; extra columns
are carried and never clash with the score column, which takes a free name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cardfold.llm.common import free_name, ranges, slices, store

BUCKETS = 1 << 17
DIM = 16
EPOCHS = 8
LEARNING_RATE = 0.5
#: The bound on labelled rows a fit reads, and the tasks that share them.
EXAMPLES = 5_000
WORKERS = 8
SLICE_BYTES = 2 << 20
NGRAMS = (3, 4, 5)
_WORD = re.compile(r"[^\W_]+")


_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1_000_003)


def _mixed(h: np.ndarray, buckets: int) -> np.ndarray:
    """A well-spread bucket of 64-bit hashes (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return (h % np.uint64(buckets)).astype(np.int64)


def word_table(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket rows of each word: the word, then its character n-grams of ``<word>``.

    Returns (rows, starts, sizes): word i owns rows[starts[i] : starts[i] + sizes[i]].
    Hashing runs over the code points of all words at once.
    """
    whole = pd.util.hash_array(np.asarray(words, dtype=object)).astype(np.uint64)
    marked = "".join(f"<{w}>" for w in words)
    cps = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    offset = np.arange(len(cps)) - first[owner]
    parts_rows, parts_owner = [_mixed(whole * _MIX, buckets)], [np.arange(len(words))]
    with np.errstate(over="ignore"):
        for n in NGRAMS:
            if len(cps) < n:
                continue
            h = np.full(len(cps) - n + 1, np.uint64(n), np.uint64)
            for t in range(n):
                h = h * _BASE + cps[t : len(cps) - n + 1 + t]
            ok = offset[: len(h)] <= (lengths[owner[: len(h)]] - n)
            parts_rows.append(_mixed(h[ok], buckets))
            parts_owner.append(owner[: len(h)][ok])
    rows, own = np.concatenate(parts_rows), np.concatenate(parts_owner)
    order = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=len(words))
    return rows[order], np.cumsum(sizes) - sizes, sizes


def counts(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(doc, word code, count) of every distinct word of each text, and the words."""
    lists = [_WORD.findall(t.lower()) if t else [] for t in texts]
    sizes = np.fromiter((len(w) for w in lists), np.int64, len(lists))
    flat = [w for ws in lists for w in ws]
    if not flat:
        z = np.zeros(0, np.int64)
        return z, z, z, []
    codes, uniq = pd.factorize(pd.Series(flat, dtype=object))
    docs = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    pairs, n = np.unique(docs * len(uniq) + codes, return_counts=True)
    return pairs // len(uniq), pairs % len(uniq), n, list(uniq)


class WordSums:
    """Per task: the summed table rows and row count of each word met, kept while
    the cache holds at most ``most`` words (then it starts again)."""

    def __init__(self, table: np.ndarray, most: int = 500_000):
        self.table, self.most = table, most
        self.index: dict[str, int] = {}
        self.sums = np.zeros((0, table.shape[1]), np.float32)
        self.sizes = np.zeros(0, np.float32)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) + len(words) > self.most:
            self.index, self.sums, self.sizes = {}, self.sums[:0], self.sizes[:0]
        at = np.fromiter((self.index.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [words[i] for i in new]
            rows, starts, sizes = word_table(fresh)
            sums = np.add.reduceat(self.table[rows], starts, axis=0)
            base = len(self.sizes)
            self.index.update(zip(fresh, range(base, base + len(fresh))))
            self.sums = np.concatenate([self.sums, sums])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.float32)])
            at[new] = np.arange(base, base + len(fresh))
        return self.sums[at], self.sizes[at]


def doc_vectors(texts: list, table: np.ndarray, cache: WordSums | None = None) -> np.ndarray:
    """The mean feature row of each text (zeros for texts without words)."""
    out = np.zeros((len(texts), table.shape[1]), np.float32)
    doc, code, count, words = counts(texts)
    if not len(doc):
        return out
    sums, sizes = (cache or WordSums(table)).of(words)
    n = count.astype(np.float32)
    weighted = sums[code] * n[:, None]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    totals = np.add.reduceat(sizes[code] * n, first)
    out[doc[first]] = np.add.reduceat(weighted, first, axis=0) / totals[:, None]
    return out


def sparse_features(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, weights) of each text: its vector is weights @ E[rows]."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.float32))
    doc, code, count, words = counts(texts)
    if not len(doc):
        return [empty for _ in texts]
    rows, starts, sizes = word_table(words)
    out = [empty for _ in texts]
    bounds = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
    for a, b in zip(bounds[:-1], bounds[1:]):
        c, n = code[a:b], count[a:b].astype(np.float64)
        at = ranges(starts[c], sizes[c])
        weight = np.repeat(n, sizes[c])
        uniq, inverse = np.unique(rows[at], return_inverse=True)
        out[doc[a]] = (uniq, (np.bincount(inverse, weights=weight) / weight.sum()).astype(np.float32))
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    def __init__(self, table: np.ndarray, out: np.ndarray, bias: np.ndarray):
        self.table, self.out, self.bias = table, out, bias

    @classmethod
    def start(cls, buckets: int = BUCKETS, dim: int = DIM, seed: int = 0) -> Model:
        rng = np.random.default_rng(seed)
        table = rng.uniform(-1.0 / dim, 1.0 / dim, (buckets, dim)).astype(np.float32)
        return cls(table, np.zeros((2, dim), np.float32), np.zeros(2, np.float32))

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return softmax(vectors @ self.out.T.astype(np.float64) + self.bias)[:, 1]


def sgd(model: Model, examples: list[tuple[np.ndarray, np.ndarray, int]], rates: np.ndarray) -> np.ndarray:
    """One pass of SGD over ``examples`` in place; returns the table rows it changed.

    A row's step is its weight times the number of the text's rows, so the step of
    the mean vector does not shrink with the length of the text.
    """
    touched = np.zeros(len(model.table), bool)
    for (rows, weights, label), rate in zip(examples, rates):
        if not len(rows):
            h = np.zeros(model.table.shape[1], np.float32)
        else:
            h = weights @ model.table[rows]
        p = softmax(model.out @ h + model.bias)
        g = p.copy()
        g[label] -= 1.0
        grad_h = model.out.T @ g
        model.out -= rate * np.outer(g, h).astype(np.float32)
        model.bias -= rate * g.astype(np.float32)
        if len(rows):
            model.table[rows] -= (rate * len(rows) * weights[:, None] * grad_h[None, :]).astype(np.float32)
            touched[rows] = True
    return np.flatnonzero(touched)


def examples_of(docs: DataFrame, labels: DataFrame, label: str, train: Column, examples: int = EXAMPLES) -> DataFrame:
    """Hashed features of at most ``examples`` labelled training rows (``fit`` stores them).

    The sample is the ``examples`` label rows of smallest id hash, so its size is
    proven before it is broadcast; duplicate (id, text) rows count once.
    """
    chosen = (
        labels.where(train & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("_q_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                yield features_of(batch)

    def features_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = sparse_features(batch.column("text").to_pylist())
        return pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("_q_label"),
                    "rows": pa.array([r.astype(np.int32) for r, _ in got], pa.list_(pa.int32())),
                    "weights": pa.array([w for _, w in got], pa.list_(pa.float32())),
                }
            )

    schema = "doc_id long, label int, rows array<int>, weights array<float>"
    return rows.mapInArrow(run, schema)


def fit(examples: DataFrame, epochs: int = EPOCHS, rate: float = LEARNING_RATE, workers: int = WORKERS, seed: int = 0) -> Model:
    """SGD by parameter averaging: each task trains on its share, the driver averages."""
    spark = examples.sparkSession
    model = Model.start(seed=seed)
    examples = store(examples, "quality-examples")
    n = examples.count()
    if not n:
        return model
    # Each share holds 2,000 examples at least: averaging thin shares learns little.
    shares = store(examples.repartition(max(1, min(workers, n // 2000)), F.xxhash64("doc_id")), "quality-shares")
    for epoch in range(epochs):
        held = spark.sparkContext.broadcast((model.table, model.out, model.bias))
        first, last = rate * (1 - epoch / epochs), rate * (1 - (epoch + 1) / epochs)

        def run(batches: Iterator[pa.RecordBatch], held=held, first=first, last=last) -> Iterator[pa.RecordBatch]:
            table, out, bias = held.value
            local = Model(table.copy(), out.copy(), bias.copy())
            items = []
            for batch in batches:
                rows, weights = batch.column("rows"), batch.column("weights")
                at = rows.offsets.to_numpy()
                flat_rows = rows.values.to_numpy(zero_copy_only=False).astype(np.int64)
                flat_weights = weights.values.to_numpy(zero_copy_only=False)
                for i, label in enumerate(batch.column("label").to_pylist()):
                    items.append((flat_rows[at[i] : at[i + 1]], flat_weights[at[i] : at[i + 1]], int(label)))
            if not items:
                return
            order = np.random.default_rng(epoch).permutation(len(items))
            items = [items[i] for i in order]
            touched = sgd(local, items, np.linspace(first, last, len(items))).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "n": [len(items)],
                    "rows": pa.array([touched], pa.list_(pa.int64())),
                    "table": [local.table[touched].tobytes()],
                    "out": [local.out.tobytes()],
                    "bias": [local.bias.tobytes()],
                }
            )

        schema = "n long, rows array<long>, table binary, out binary, bias binary"
        total, table_delta = 0, np.zeros_like(model.table)
        out_sum, bias_sum = np.zeros_like(model.out), np.zeros_like(model.bias)
        for r in shares.mapInArrow(run, schema).toLocalIterator():
            rows = np.asarray(r["rows"], np.int64)
            new = np.frombuffer(r["table"], np.float32).reshape(len(rows), -1)
            table_delta[rows] += r["n"] * (new - model.table[rows])
            out_sum += r["n"] * np.frombuffer(r["out"], np.float32).reshape(model.out.shape)
            bias_sum += r["n"] * np.frombuffer(r["bias"], np.float32)
            total += r["n"]
        held.destroy()
        model = Model(model.table + table_delta / total, out_sum / total, bias_sum / total)
    return model


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with ``score`` in [0, 1]: the probability of label 1, every whole text."""
    spark = docs.sparkSession
    out = free_name(docs, out) if out in docs.columns else out
    held = spark.sparkContext.broadcast((model.table, model.out, model.bias))
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights, bias = held.value
        local = Model(table, weights, bias)
        cache = WordSums(table)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                vectors = doc_vectors(part.column(text_at).to_pylist(), local.table, cache)
                scores = pa.array(local.scores(vectors), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, out])

    schema = StructType([*docs.schema.fields, StructField(out, DoubleType(), True)])
    return docs.mapInArrow(run, schema)
