"""Exact duplicates by progressive refinement, in DataFrame operations only.

Rows are grouped by the length of their normalised text, the groups of two or
more by a hash of a short prefix, and only rows that still have company by the
full SHA-256. What is decided at each level is a small table of groups, so the
shuffles carry lengths and hashes and never a text.

Defined results: a null text counts as empty and all empty texts are equal; a
null id sorts after every other; of rows that tie in length and id (repeated
rows) exactly one stays; an empty table gives an empty result; columns other
than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, materialize, row_keyed, text_or_empty

PREFIX_CHARS = 64
#: Up to so many surviving (length, prefix) groups are broadcast: at 16 bytes
#: of key each, below 20 MB in an executor. Beyond it the groups are shuffled.
BROADCAST_GROUPS = 200_000


def normalised(text: str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def exact_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", digest_all: bool = False, row_id: str | None = None) -> DataFrame:
    """What becomes of each row: doc_id, n_chars, digest, keep_id, group_size, kept, row_id.

    Without digest_all only rows of surviving (length, prefix) groups are
    returned, which all duplicates are among, and only they are read and hashed
    in full. With digest_all the caller wants the digest of every row, so every
    row is returned and the digest is taken along with the length; rows of
    surviving groups alone take part in the grouping by digest either way.
    row_id: a column that numbers the rows of docs, else one is made.
    """
    body, digest = normalised(text), F.unhex(F.sha2(normalised(text), 256))
    level = [F.length(body).alias("norm_len"), F.xxhash64(F.substring(body, 1, PREFIX_CHARS)).alias("prefix_hash")]
    own = [F.col(doc_id).alias("doc_id"), F.char_length(text_or_empty(text)).cast("long").alias("n_chars")]
    number = F.monotonically_increasing_id()
    own += [F.col(row_id).alias("row_id")] if row_id else []

    rows = docs.select(*own, *level, *([digest.alias("digest")] if digest_all else []))
    if digest_all:
        rows = materialize(rows if row_id else rows.withColumn("row_id", number), "exact-rows")
    lengths = materialize(rows.groupBy("norm_len").count().where("count > 1").select("norm_len"), "exact-lengths")
    near = (
        rows.join(lengths, "norm_len", "left_semi")
        .groupBy("norm_len", "prefix_hash")
        .count()
        .where("count > 1")
        .select("norm_len", "prefix_hash")
    )
    near = materialize(near, "exact-prefixes")
    if digest_all:
        left = rows.join(near, ["norm_len", "prefix_hash"], "left_semi")
    else:
        left = docs.select(*own, *level, body.alias("body"))
        if near.count() <= BROADCAST_GROUPS:
            left = left.join(F.broadcast(near), ["norm_len", "prefix_hash"], "left_semi")
            left = left.withColumn("digest", F.unhex(F.sha2("body", 256))).drop("body")
        else:  # the digest is made before the shuffle, which so carries no text
            left = left.withColumn("digest", F.unhex(F.sha2("body", 256))).drop("body")
            left = left.join(near, ["norm_len", "prefix_hash"], "left_semi")
        left = materialize(left if row_id else left.withColumn("row_id", number), "exact-survivors")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    groups = (
        left.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .where("group_size > 1")
        .select("digest", "group_size", F.col("best.doc_id").alias("best_id"), F.col("best.row_id").alias("best_row"))
    )
    groups = materialize(groups, "exact-groups")
    every = rows if digest_all else left
    one = F.col("group_size").isNull()
    return every.join(groups, "digest", "left").select(
        "doc_id",
        "n_chars",
        "digest",
        F.when(one, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (one | (F.col("row_id") == F.col("best_row"))).alias("kept"),
        "row_id",
    )


def drop_exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns and nothing else.

    Rows that repeat an id, or have none, are told apart by a row number; the
    keys of dropped rows are joined back.
    """
    named, row = row_keyed(docs, doc_id, "exact-input")
    fates = exact_groups(named, doc_id=doc_id, text=text, row_id=row)
    dropped = materialize(fates.where(~F.col("kept")).select(F.col("row_id").alias(row)), "exact-dropped")
    return named.join(dropped, row, "left_anti").drop(row)
