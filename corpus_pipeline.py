"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as
Parquet and read again as the docs of the next. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.llm import bpe, exact_dedup, mixing, quality_classifier, simhash_dedup
from wayfuse.llm.common import in_fold, materialize
from wayfuse.llm.queries import table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go. Labels of the held-out fold are not learnt from."""
    labels = table(spark, sf_dir, "labels").where(~in_fold(5))
    model = quality_classifier.train(docs, labels)
    return quality_classifier.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share 0.8 or more of their shingles of five words, by fingerprints, the first stays."""
    return simhash_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and n_tokens of every document of the mix."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary()).drop("text")
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]
#: The classifier, the components of near-duplicates and the encoder have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
