"""Merkle manifest, quality classifier and hard negatives against plain models."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardfold.llm import hardneg, manifest, quality
from cardfold.llm import queries as corpus
from cardfold.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


def H(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    s = str(int(v)) if isinstance(v, (int, np.integer)) else str(v)
    return f"{len(s.encode())}:{s}"


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Level by level: the root and each node's (left, right) siblings a level."""
    wit = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    level = list(nodes)
    while len(level) > 1:
        nxt, nxt_members = [], []
        for a in range(0, len(level), 3):
            run = level[a : a + 3]
            for j in range(len(run)):
                for i in members[a + j]:
                    wit[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            nxt.append(H("".join(run)))
            nxt_members.append([i for m in members[a : a + 3] for i in m])
        level, members = nxt, nxt_members
    return level[0], wit


def plain_manifest(rows: list[dict]) -> dict:
    """doc position -> (leaf, subroot, root, witness) by a level-wise model."""
    for r in rows:
        r["leaf"] = H("".join(enc(r[c]) for c in manifest.FIELDS))
    by_source: dict = {}
    for i, r in enumerate(rows):
        by_source.setdefault(r["source"], []).append(i)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], {}
    for s in sources:
        idx = sorted(by_source[s], key=lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, rows[i]["leaf"]))
        sub, wit = plain_tree([rows[i]["leaf"] for i in idx])
        subroots.append(sub)
        for i, w in zip(idx, wit):
            inner[i] = (sub, w)
    root, top = plain_tree(subroots)
    out = {}
    for k, s in enumerate(sources):
        for i in by_source[s]:
            sub, w = inner[i]
            out[i] = (rows[i]["leaf"], sub, root, w + top[k])
    return out


def fold(leaf, wit):
    for l, r in wit:
        leaf = H(l + leaf + r)
    return leaf


ROWS = [
    (1, "b", "en", 3, "a\nb"),
    (2, "b", None, None, None),
    (2, "b", None, None, None),
    (3, None, "de", 0, ""),
    (None, "a", "fr", 5, "x\ny\n"),
    (4, "a", "en", 2, "é\n"),
    (5, "ü", "en", 1, "z"),
    *[(10 + i, "b", "en", i, f"t{i}\n" * (i % 3)) for i in range(20)],
]


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_equals_plain_model(spark, depth):
    df = spark.createDataFrame(ROWS, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    df = df.withColumns({"leaf": F.lit(1), "pos": F.lit("x"), "key": F.lit(2)})  # clashing names
    got = manifest.manifest(df, depth=depth).select(
        "doc_id", "source", "leaf", "subroot", "root", manifest.proof(F.col("lefts"), F.col("rights")).alias("p"),
        manifest.fold(F.col("leaf"), F.col("lefts"), F.col("rights")).alias("f"),
    ).toPandas()
    rows = [dict(zip(manifest.FIELDS, r)) for r in ROWS]
    want = plain_manifest(rows)
    assert len(got) == len(rows)
    expected = sorted((v[0], v[1], v[2], H("".join(l + r for l, r in v[3]))) for v in want.values())
    assert sorted(zip(got.leaf, got.subroot, got.root, got.p)) == expected
    assert (got.f == got.root).all()
    assert got.root.nunique() == 1


def test_manifest_empty_and_single(spark):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    assert manifest.manifest(spark.createDataFrame([], schema)).count() == 0
    one = manifest.manifest(spark.createDataFrame([(1, "s", "en", 1, "a")], schema)).collect()[0]
    assert one.leaf == one.subroot == one.root and one.lefts == []


def test_op11_query_against_plain_model(spark):
    got = corpus.op11_merkle_manifest(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = [
        {c: (None if pd.isna(v) else (int(v) if c in ("doc_id", "n_chars") else v)) for c, v in r.items() if c in manifest.FIELDS}
        for r in docs.to_dict("records")
    ]
    want = plain_manifest(rows)
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: want[i] for i, r in enumerate(rows)}
    for g in got.itertuples():
        leaf, sub, root, wit = by_id[g.doc_id]
        r = next(x for x in rows if x["doc_id"] == g.doc_id)
        assert (g.leaf, g.subroot, g.root) == (leaf, sub, root)
        assert g.proof_sha256 == H("".join(l + r_ for l, r_ in wit))
        tampered = zlib.crc32(str(g.doc_id).encode()) % 2 == 0 and r["text"] is not None
        text = r["text"].replace("\n", "") if tampered else r["text"]
        changed = H("".join(enc(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
        assert g.folded_root == fold(changed, wit)
        assert g.verified == (not tampered or "\n" not in r["text"])
    assert (~got.verified).sum() > 0


VECTORS = [
    (0, [0.5, 0.1, 0.0], 1),
    (100, [0.4, -0.2, 0.1], 2),
    (200, [0.0, 0.0, 0.0], 3),
    (300, [0.3, 0.3, 0.3], 1),
    (1, [0.5, 0.1, 0.0], 1),
    (2, [0.5, 0.1, 0.0], 1),  # ties with 1
    (3, [0.45, 0.1, 0.05], 1),
    (4, [0.4, 0.1, 0.0], 2),
    (5, [0.45, 0.09, 0.0], 3),
    (6, [0.44, 0.1, 0.0], 2),
    (7, [0.5, 0.1, 0.0], 0),  # label moves to 1
    (8, [float("nan"), 0.1, 0.0], 1),
    (9, None, 1),
    (11, [0.5, None, 0.0], 1),
    (12, [0.3, 0.1, 0.0], None),
    (13, [0.41, 0.1, 0.01], 4),
    (13, [0.41, 0.1, 0.01], 4),  # repeated row
    (14, [-0.4, 0.2, 0.0], 2),
    (15, [0.39, -0.1, 0.1], 5),
    (16, [0.35, 0.15, 0.05], 2),
    (17, [0.2, 0.2, 0.2], 6),
    (18, [float("inf"), 0.0, 0.0], 2),
]


def oracle(sql: str, tables: dict) -> pd.DataFrame:
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    return con.execute(sql).df()


@pytest.mark.parametrize("blocks", [(20_000, 4_096, 32), (5, 2, 1)])
def test_hard_negatives_against_sql(spark, monkeypatch, blocks):
    monkeypatch.setattr(hardneg, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", blocks[1])
    monkeypatch.setattr(hardneg, "CLUSTER_SIZE", blocks[2])
    df = spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, label int")
    got = hardneg.mine(df.withColumn("q", F.lit(1))).toPandas()
    pdf = pd.DataFrame(VECTORS, columns=["vec_id", "embedding", "label"])
    pdf["embedding"] = pdf["embedding"].map(lambda v: None if v is None else np.asarray(v, np.float32))
    pdf["label"] = pdf["label"].astype("Int32")
    want = oracle(ORACLES["op13_hard_negatives"], {"embeddings": pdf})
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    a = got[cols].astype("int64").sort_values(cols).reset_index(drop=True)
    b = want[cols].astype("int64").sort_values(cols).reset_index(drop=True)
    assert len(b) > 0
    pd.testing.assert_frame_equal(a, b)


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    """The contract over (vec_id, vector, label) in Python's integers; all rows valid and different."""
    rows = [(i, [math.floor(256 * x) for x in v], (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    out = []
    for i, q, y in rows:
        if i % 100:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(q, w)), j, z) for j, w, z in rows)
        for ps, p in [(-s, j) for s, j, z in ranked if z == y and j != i][:5]:
            fit = [(-s, j) for s, j, z in ranked if z != y and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(i, p, k, j, ps, s) for k, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    return sorted(tuple(r) for r in hardneg.mine(df).collect())


def test_hard_negatives_in_many_partitions(spark, monkeypatch):
    """Row and anchor blocks meet also where their partitions stay apart."""
    monkeypatch.setattr(hardneg, "ROW_BLOCK", 40)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 2)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), int(i % 3)) for i in [*range(150), *range(200, 900, 100)]]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        got = mined(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain_negatives(rows) and len(got) > 100


def test_hard_negatives_of_large_components(spark):
    """Scores whose hundredfold is beyond 64 bits, anchors of almost one direction."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=8) * 2e6
    rows = [(100 * i, (base + rng.normal(size=8)).tolist(), i % 2) for i in range(20)]
    rows += [(i, (base * rng.uniform(0.8, 1) + rng.normal(size=8) * 1e5).tolist(), i % 3) for i in range(1, 90)]
    got = mined(spark, rows)
    assert got == plain_negatives(rows) and len(got) > 100


def test_hard_negatives_of_repeated_ids(spark):
    """Two positives of one id keep a list of negatives each."""
    rows = [(0, [1.0, 0.0], 5), (3, [1.0, 0.5], 6), (3, [0.95, 0.1], 6)]  # label 5 of id 0 moves to 6
    rows += [(22 + i, [0.8 + i / 40, 0.1], 2) for i in range(6)]
    got = mined(spark, rows)
    assert got == plain_negatives(rows)
    assert len({r[4] for r in got if r[1] == 3}) == 2


def test_op13_query_against_sql(spark):
    got = corpus.op13_hard_negatives(spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(ORACLES["op13_hard_negatives"]).df()
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    a = got[cols].astype("int64").sort_values(cols).reset_index(drop=True)
    b = want[cols].astype("int64").sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_hard_negatives_empty(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hardneg.mine(empty).count() == 0


def test_word_table_matches_plain_ngrams():
    rows, starts, sizes = quality.word_table(["ab", "héllo", "a"])
    assert sizes.tolist() == [1 + 2 + 1, 1 + 5 + 4 + 3, 1 + 1]
    again, _, _ = quality.word_table(["héllo"])
    assert sorted(rows[starts[1] : starts[1] + sizes[1]].tolist()) == sorted(again.tolist())


def test_doc_vectors_are_means_of_feature_rows():
    table = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    texts = ["Ab ab cd", None, "", "x"]
    got = quality.doc_vectors(texts, table)
    feats = []
    for w in ["ab", "ab", "cd"]:
        r, _, _ = quality.word_table([w])
        feats.extend(r.tolist())
    assert np.allclose(got[0], table[feats].mean(axis=0), atol=1e-5)
    assert not got[1].any() and not got[2].any()
    (rows, weights), *_ = quality.sparse_features(texts)
    assert np.allclose(weights @ table[rows], got[0], atol=1e-5)


def test_quality_edges(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", 9), (2, None, 9), (3, "", 9), (3, "", 9), (4, "spam spam", 9)],
        "doc_id bigint, text string, score int",
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    examples = quality.examples_of(docs, labels, "quality", F.lit(True))
    model = quality.fit(examples)
    got = quality.score(docs, model).toPandas()
    assert "score" in got and "_score" in got  # the clashing column stays
    assert np.allclose(got["_score"], 0.5)
    assert quality.score(docs.limit(0), model).count() == 0


def auc(y, s):
    r = pd.Series(s).rank().values
    n1 = y.sum()
    n0 = len(y) - n1
    return (r[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_op12_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = corpus.op12_quality_classifier(spark, sf).toPandas()
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    assert len(got) == len(docs)
    assert got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.quality.values, held.score.values) > 0.6
    assert ((held.predicted == 1) == (held.score >= 0.7)).all()
