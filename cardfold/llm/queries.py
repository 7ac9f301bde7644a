"""The registered queries of the corpus operators, in the form of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardfold.llm import (
    decontaminate,
    extract_text,
    fingerprint,
    hardneg,
    kdshard,
    manifest,
    neardup,
    packing,
    quality,
    sanitise,
    substring,
    toxicity,
    urlfilter,
)
from cardfold.llm.common import digest, table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark, sf_dir):
    found = substring.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        removed.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_kd_sharding(spark, sf_dir):
    placed = kdshard.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_html_extraction(spark, sf_dir):
    found = extract_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep_html=False)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitise.sanitise(docs, only_private=True)
    spans = F.col("spans")
    counts = [sanitise.n_of(spans, kind).alias(f"n_{kind}") for kind in sanitise.KINDS[:4]]
    base = F.sha2(sanitise.listed(spans, base=True).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), sanitise.listed(spans).alias("spans"))


def op5_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.find_matches(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
        keep_text=False,
    )
    f = F.col("found")
    return found.select(
        "doc_id",
        f["n_words"].alias("n_words"),
        decontaminate.n_hit(f).alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        digest(F.array_sort(f["items"])).alias("items_sha256"),
        decontaminate.contaminated(f).alias("contaminated"),
    )


def op6_minhash_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: (verdict, host, path): the rules that this query is asked for.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    found = urlfilter.match(pages, rules)
    return found.select(
        "page_id",
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"),
    )


def op8_best_fit_packing(spark, sf_dir):
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    packed = packing.pack(pieces)
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_scaled_sketch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"tie": F.xxhash64("text"), "n_chars": F.char_length("text").cast("long")})
    docs = fingerprint.with_next(docs, "doc_id", "tie", ["text"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    docs = docs.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), half)))
    for text, name in (("text", "own"), ("edited", "edited"), ("next_text", "next")):
        docs = fingerprint.with_sketch(docs, text, f"{name}_sketch", all_out=f"{name}_all")
    own, edited, following = ((F.col(f"{n}_sketch"), F.col(f"{n}_all")) for n in ("own", "edited", "next"))
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.fingerprint(*own).alias("fingerprint"),
        fingerprint.fingerprint(*edited).alias("edited_fingerprint"),
        fingerprint.containment(own[0], edited[0], own[1], edited[1]).alias("near_edited"),
        fingerprint.containment(own[0], following[0], own[1], following[1]).alias("near_next"),
    )


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.model_of(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep_text=False)
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op11_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    changed = manifest.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    m = manifest.manifest(table(spark, sf_dir, "documents"), carry={"changed": changed})
    folded = manifest.fold(F.col("changed"), F.col("lefts"), F.col("rights"))
    return m.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof(F.col("lefts"), F.col("rights")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def op12_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    examples = quality.examples_of(docs, table(spark, sf_dir, "labels"), "quality", ~held_out)
    scored = quality.score(docs, quality.fit(examples))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op13_hard_negatives(spark, sf_dir):
    return hardneg.mine(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from cardfold.llm.oracles import ORACLES

    return dict(ORACLES)
