"""Corpus pipeline: toxicity filter, line dedup, near-duplicate removal, mixing to target weights, packing.

Each stage reads all that its predecessor kept, as a table. All but the last return the columns of ``documents``.
Null texts, empty tables, repeated rows and rows without doc_id pass as the operators state; further columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import boilerplate, hyperminhash, mixing, packing, toxicity
from loadcast.llm.common import keep, read
from loadcast.llm.tokens import tokenizer_path


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the table's labels, doesn't find toxic."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are frequent on their source; ``n_chars`` is that of the new text."""
    counts = "_".join(["lines", *docs.columns])  # longer than any column's name
    out = boilerplate.drop_boilerplate(docs, counts=counts)
    if "n_chars" in docs.columns:
        changed = F.col(f"`{counts}`.dropped") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return hyperminhash.drop_near_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in sequences of 4096 ids; ids as little-endian unsigned 32-bit integers."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean_language),
    ("line_dedup", without_boilerplate),
    ("minhash_near_dedup", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

# A trained network, sketches and token ids are beyond SQL. The tests of each operator hold it to brute force;
# tests/llm/test_pipeline.py holds each stage to its operator, and the line stage to planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a kept table, which the next one reads."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
