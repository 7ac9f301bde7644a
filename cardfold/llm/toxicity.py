"""Toxicity with a counterfactually regularised classifier.

A logistic model over hashed words and word beginnings. Labelled sentences that
name an identity group are paired with copies that name other groups, and the
loss penalises the squared difference of the two logits (counterfactual logit
pairing), so neutral mentions of a group do not move the score.

The classifier is fitted on a bounded sample of the labels, taken by a hash of the
id: features are counted over ``label_rows`` labels, weights fitted on ``sample`` of
them; scoring reads every whole text.

Features are presence, not counts. Only those are fitted whose presence depends on
the label beyond chance (chi-squared against the number of features tried), so the
many rare words of a long text do not add up to a score.

Defined results. Null or empty text: the model's bias. Labels, language, source
and id never enter a score. Without labels of both classes, scores are near
the only label, or near 0 without any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardfold.llm.common import free_name, slices, store

LABEL_ROWS = 200_000
SAMPLE = 16_000
LEAST_DOCS = 3
FEATURES = 5_000
SLICE_BYTES = 8 << 20
_WORD = re.compile(r"[^\W\d_]+")
#: Groups whose neutral mention must not count, by kind (fixed lists).
IDENTITY = {
    "religion": "muslim christian jewish hindu buddhist sikh catholic atheist".split(),
    "gender": "man woman transgender nonbinary".split(),
    "plural": "men women immigrants refugees foreigners".split(),
    "orientation": "gay lesbian bisexual straight homosexual heterosexual".split(),
    "origin": "black white asian african american european mexican chinese arab indian".split(),
    "ability": "deaf blind disabled autistic".split(),
}
_KIND = {w: kind for kind, words in IDENTITY.items() for w in words}


def features(words: set[str]) -> set[str]:
    """A text's words, and the beginnings of its longer words."""
    out = set(words)
    for w in words:
        if len(w) > 5:
            out.add(w[:4] + "*")
            out.add(w[:5] + "*")
    return out


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def swapped(words: set[str], shift: int) -> set[str] | None:
    """``words`` with every identity term replaced by another of its kind."""
    named = words & _KIND.keys()
    if not named:
        return None
    out = words - named
    for w in named:
        own = IDENTITY[_KIND[w]]
        out.add(own[(own.index(w) + 1 + shift % (len(own) - 1)) % len(own)])
    return out


class Model:
    def __init__(self, names: dict[str, int], weights: np.ndarray, bias: float):
        self.weights = {n: float(weights[i]) for n, i in names.items() if weights[i]}
        self.bias = bias
        self.cut = {n[:-1] for n in self.weights if n.endswith("*")}

    def scores(self, texts: list[str | None]) -> list[float]:
        weights, cut, out = self.weights, self.cut, []
        for text in texts:
            found = words_of(text or "")
            total = self.bias + sum(weights[w] for w in found if w in weights)
            begun = {w[:k] for w in found if len(w) > 5 for k in (4, 5)} & cut
            out.append(total + sum(weights[b + "*"] for b in begun))
        return (1 / (1 + np.exp(-np.clip(out, -30, 30)))).tolist()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, documents with label 0, with label 1) of each few batches."""
    held: dict[str, list[int]] = {}

    def out():
        no, yes = zip(*held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(no, pa.int64()), pa.array(yes, pa.int64())], ["feature", "no", "yes"]
        )

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            for label, text in zip(part.column("y").to_pylist(), part.column("text").to_pylist()):
                for f in features(words_of(text)):
                    held.setdefault(f, [0, 0])[label] += 1
            if len(held) > 300_000:
                yield out()
                held.clear()
    if held:
        yield out()


def telling_features(rows: DataFrame, least_docs: int, most: int) -> list[str]:
    """Features whose presence depends on the label beyond chance, over all ``rows`` (y, text).

    The chi-squared statistic (with continuity correction) has to exceed
    2 ln(number of features), so that of many rare words next to none pass by
    luck. The ``most`` strongest are the model's size bound.
    """
    counts = rows.mapInArrow(_counts, "feature string, no bigint, yes bigint")
    counts = counts.groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    counts = store(counts.where(F.col("no") + F.col("yes") >= least_docs), "features")
    tried = counts.count()
    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if tried == 0 or len(total) < 2:
        return []
    n, n0, n1 = float(sum(total.values())), float(total[0]), float(total[1])
    with_f = F.col("no") + F.col("yes")
    gap = F.greatest(F.abs(F.col("yes") * (n0 - F.col("no")) - F.col("no") * (n1 - F.col("yes"))) - n / 2, F.lit(0.0))
    chi = n * gap * gap / F.greatest(with_f * (n - with_f) * n0 * n1, F.lit(1.0))
    best = counts.select("feature", chi.alias("chi")).where(F.col("chi") > 2 * float(np.log(max(tried, 2))))
    return [r["feature"] for r in best.orderBy(F.desc("chi"), "feature").limit(most).collect()]


def _indexed(names: dict[str, int]):
    """Rows (h, y, own, swaps): a text's features and those of its counterfactual copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, swaps = [], []
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                other = swapped(words, h)
                own.append([names[f] for f in features(words) if f in names])
                swaps.append(None if other is None else [names[f] for f in features(other) if f in names])
            kind = pa.list_(pa.int32())
            columns = [batch.column("h"), batch.column("y"), pa.array(own, kind), pa.array(swaps, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["h", "y", "own", "swaps"])

    return run


def fit(names: dict[str, int], rows: list[tuple[int, list[int], list[int] | None]], penalty: float, ridge: float, rounds: int) -> Model:
    """Adaptive-step gradient descent on log loss + ridge + counterfactual penalty."""
    y = np.array([r[0] for r in rows], float)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Model({}, np.zeros(0), 30.0 if share else -30.0)
    pairs = [(i, r[2]) for i, r in enumerate(rows) if r[2] is not None]

    def flat(lists):
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return np.array([i for x in lists for i in x], np.int64), owner

    own, owner = flat([r[1] for r in rows])
    swap, swap_owner = flat([p for _, p in pairs])
    first, size = np.array([i for i, _ in pairs], np.int64), len(names)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    seen, seen_b = np.full(size, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(owner, w[own], len(rows)) + b
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        pull = np.zeros(size)
        if pairs:
            gap = 2 * penalty * (z[first] - np.bincount(swap_owner, w[swap], len(pairs)) - b)
            g[first] += gap
            pull = np.bincount(swap, gap[swap_owner], size)
        grad = np.bincount(own, g[owner], size) - pull + ridge * w
        shift = g.sum() - (gap.sum() if pairs else 0.0)
        seen = 0.9 * seen + grad**2
        seen_b = 0.9 * seen_b + shift**2
        w -= 0.15 * grad / np.sqrt(seen)
        b -= 0.15 * shift / np.sqrt(seen_b)
    return Model(names, w, b)


def train(
    rows: DataFrame,
    fit_below: int,
    least_docs: int = LEAST_DOCS,
    most_features: int = FEATURES,
    penalty: float = 1.0,
    ridge: float = 0.003,
    rounds: int = 600,
) -> Model:
    """Features are chosen over all ``rows`` (h, y, text); weights are fitted on
    those whose hash ``h`` is at most ``fit_below``.
    """
    rows = rows.where(F.col("text").isNotNull())
    names = {f: i for i, f in enumerate(telling_features(rows.select("y", "text"), least_docs, most_features))}
    few = rows.where(F.col("h") <= fit_below).select("h", "y", "text")
    indexed = few.mapInArrow(_indexed(names), "h bigint, y int, own array<int>, swaps array<int>")
    held = sorted(indexed.collect(), key=lambda r: (r["h"], r["y"], r["own"]))
    return fit(names, [(r["y"], r["own"], r["swaps"]) for r in held], penalty, ridge, rounds)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with a score from 0 to 1 of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != score_col and (keep_text or f.name != text_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                found = own.scores(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(found, pa.float64())], [*names, score_col]
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{score_col}` double"])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def model_of(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_rows: int = LABEL_ROWS,
    sample: int = SAMPLE,
    **options,
) -> Model:
    """Trained on labelled documents that are not held out.

    At most ``label_rows`` labels are used, those with the smallest hashes of their
    ids; their ids are sent to the documents, so no text is shuffled. The weights
    are fitted on the first ``sample`` of them.
    """
    label = F.col(label_col).cast("int")
    named = labels.where(~held_out(F.col(id_col)) & label.isin(0, 1))
    named = named.select(id_col, F.xxhash64(F.col(id_col)).alias("h"), label.alias("y")).dropDuplicates([id_col])
    chosen = store(named.orderBy("h").limit(label_rows), "labels")
    cut = chosen.orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if cut is None:
        return Model({}, np.zeros(0), -30.0)
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col)
    return train(rows.select("h", "y", "text"), cut, **options)


def keep_civil(docs: DataFrame, model: Model, least: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` scored below ``least``, with their columns."""
    name = free_name(docs, "score")
    return score(docs, model, score_col=name, **options).where(F.col(name) < least).drop(name)
