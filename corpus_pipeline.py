"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardfold.llm import decontaminate, neardup, packing, sanitise, toxicity
from cardfold.llm.common import store, table, tokenizer_path


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    model = toxicity.model_of(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_civil(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced in the texts."""
    return sanitise.sanitise(docs, spans_col="pii_spans").drop("pii_spans")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in as few sequences as possible."""
    pieces = packing.pack(packing.tokenized_pieces(docs, tokenizer_path()))
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", civil),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("pii", sanitised),
    ("best-fit packing", packed),
]

#: SQL cannot express the learned score and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    *early, (_, last) = STAGES
    for name, stage in early:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
