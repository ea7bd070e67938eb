"""Shared pieces: scratch tables, word splitting, Arrow batch mapping."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, `[\x20\x09-\x0D]`.
WHITE = " \t\n\x0b\x0c\r"
#: The same set as a character class for Java regular expressions.
WHITE_CLASS = r"[\x20\x09-\x0D]"

_made: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir.

    Where it is unset a temporary folder is used, which is only right for one
    machine: on any other master the setting must be given.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="wayfuse-"))
    return made


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared scratch folder and reads it back.

    This cuts the lineage: an executor that is lost later costs a re-read of
    files, not a recomputation, and the size of the table is known to the
    planner from then on.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/wayfuse-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def row_keyed(docs: DataFrame, doc_id: str, label: str) -> tuple[DataFrame, str]:
    """docs with a column that tells its rows apart, and that column's name, which clashes with no other.

    Where integer ids do so already they are the key and nothing is written; a
    look at the ids alone tells. Else the rows are numbered and written once.
    """
    row = f"row_{uuid.uuid4().hex}"
    if docs.schema[doc_id].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        worst = docs.groupBy(F.col(doc_id).alias("i")).count().agg(F.max("count"), F.count_if(F.col("i").isNull())).first()
        if worst[0] in (None, 1) and not worst[1]:
            return docs.withColumn(row, F.col(doc_id).cast("bigint")), row
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), label), row


@atexit.register
def clean_scratch() -> None:
    """Deletes the tables that were written on the way, which results that are not read yet may need; done at the end of the process, or by a long session between queries."""
    while _made:
        spark, path = _made.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session is over; nothing to clean with
            return


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def in_fold(folds: int, name: str = "doc_id") -> Column:
    """True for the held-out fold: crc32 of the id as text, remainder 0. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % folds == 0, F.lit(False))


def words_of(text: bytes | None) -> list[bytes]:
    """The `[^\\x20\\x09-\\x0D]+` runs of a text in UTF-8."""
    return text.split() if text else []


def texts_of(table: pa.Table, name: str = "text", rows: int = 1000) -> Iterator[bytes | None]:
    """The texts of a batch in UTF-8, some rows at a time, so that they are not all held twice."""
    for at in range(0, table.num_rows, rows):
        yield from table.column(name).slice(at, rows).cast(pa.large_binary()).to_pylist()


def map_batches(df: DataFrame, fn: Callable[[pa.Table], Iterator[pa.RecordBatch] | pa.Table], schema: str) -> DataFrame:
    """mapInArrow where fn takes one batch as a table and returns a table.

    Text columns are handed over as Spark sends them; a batch holds at most
    spark.sql.execution.arrow.maxRecordsPerBatch rows.
    """

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(pa.Table.from_batches([batch])).to_batches()

    return df.mapInArrow(run, schema)


MET = "key long, entered boolean, node long"


def meeting(batches):
    """Of rows sorted by key, entries first, those of keys that have an entry and another line; equal rows once."""
    last, alive, head = None, False, None  # the row before, whether its key has an entry, and that entry while it is alone

    def emit(key, entered, node):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(entered, pa.bool_()), pa.array(node, pa.int64())], names=["key", "entered", "node"])

    for batch in batches:
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        entered = batch.column("entered").to_numpy(zero_copy_only=False)
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (entered[1:] != entered[:-1])
        if last is not None and len(key):
            fresh[0] = (int(key[0]), bool(entered[0]), int(node[0])) != last
        key, entered, node = key[fresh], entered[fresh], node[fresh]
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = last is None or int(key[0]) != last[0]
        group = np.cumsum(new)  # 0: goes on from the batch before
        size = np.bincount(group, minlength=group[-1] + 1)
        lives = np.zeros(group[-1] + 1, bool)
        lives[0] = alive
        lives[1:] = entered[new]
        if size[0] and alive and head is not None:
            yield emit([head[0]], [True], [head[1]])
        if size[0] or group[-1] > 0:
            head = None
        many = size > 1
        many[0] = True
        pick = (lives & many)[group]
        yield emit(key[pick], entered[pick], node[pick])
        if group[-1] > 0:
            alive = bool(lives[-1])
            if alive and size[-1] == 1:
                head = int(key[-1]), int(node[-1])
        last = int(key[-1]), bool(entered[-1]), int(node[-1])
