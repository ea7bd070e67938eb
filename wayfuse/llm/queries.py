"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, class_lm, exact_dedup, html_text, line_dedup, mixing, passage_dedup, quality_classifier, simhash_dedup, weak_rules
from .common import in_fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public tokenizer's file."""
    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), h AS (SELECT doc_id, n, sha256(body) AS text_sha256 FROM d),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS rn,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM h
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, rn = 1 AS kept, text_sha256 FROM r
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.per_document(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocabulary()).drop("text")
    back = bpe.decode(coded, vocabulary())
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, takes = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken_words(placed, takes).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~in_fold(5))
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.with_score(docs, model)
    return scored.select(
        "doc_id",
        in_fold(5).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_rules.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept")


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, scored = class_lm.train_and_score(docs, in_fold(10))
    return scored.select("doc_id", in_fold(10).alias("held_out"), "n_tokens", "n_known", F.lit(model.size).cast("long").alias("train_tokens"), "base_score", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_bpe": op4_bpe,
    "op5_passages": op5_passages,
    "op6_mix": op6_mix,
    "op7_quality": op7_quality,
    "op8_weak_rules": op8_weak_rules,
    "op9_class_lm": op9_class_lm,
    "op10_simhash": op10_simhash,
}
ORACLE_SQL = {"op2_exact_dedup": OP2_SQL}
