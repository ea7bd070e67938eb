"""Position and message views over the test tables' event stream."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir; a temporary folder where that is unset, which is right for one machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wayfuse-")
    return f"{base.rstrip('/')}/wayfuse-{name}-{uuid.uuid4().hex}"


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written by way of Spark's file systems."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(text.encode()))
    out.close()


def _millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click")).select(
        F.col("user_id").cast("string").alias("vehicle_id"),
        _millis().alias("timestamp_ms"),
        (F.lit(50.0) + k / F.lit(100.0)).alias("latitude"),
        (F.lit(6.0) + (F.col("event_id") % 1000) / F.lit(1000.0)).alias("longitude"),
        F.col("value").alias("altitude"),
        (F.col("value") / 10.0).alias("speed_mps"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("heading_deg"),
        F.lit("/gps/fix").alias("topic"),
        F.col("event_id").alias("ordinal"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "CAM").when(F.col("event_type") == "signup", "DENM").otherwise("UNKNOWN")
    way = F.when(F.col("event_id") % 3 == 0, "uplink_to_rsu").when(F.col("event_id") % 3 == 1, "downlink_from_rsu").otherwise("v2v")
    vehicle = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup", "error")).select(
        _millis().alias("timestamp_ms"),
        F.when(F.col("event_id") % 11 == 0, "unknown").otherwise(vehicle).alias("vehicle_id"),
        kind.alias("message_type"),
        (F.char_length("props") + F.floor("value")).cast("bigint").alias("message_size_bytes"),
        vehicle.alias("sender_id"),
        F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 7).cast("string")).alias("receiver_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("latency_ms"),
        F.lit(None).cast("double").alias("rssi_dbm"),
        F.lit("/v2x/cam").alias("topic"),
        way.alias("direction"),
        F.col("event_id").alias("ordinal"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions under the names of trajectory samples."""
    return positions(spark, sf_dir).select("vehicle_id", "timestamp_ms", F.col("latitude").alias("lat_deg"), F.col("longitude").alias("lon_deg"), F.col("altitude").alias("alt_m"), F.lit(0.0).alias("x_m"), F.lit(0.0).alias("y_m"), "speed_mps", "heading_deg", "ordinal")


#: The same views in DuckDB's SQL.
SQL = """
WITH pos AS (
  SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_ms,
    50.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS INTEGER) / 100.0::DOUBLE AS latitude,
    6.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE AS longitude, value AS altitude, value / 10.0::DOUBLE AS speed_mps,
    CAST((event_id * 37) % 360 AS DOUBLE) AS heading_deg, '/gps/fix' AS topic, event_id AS ordinal
  FROM events WHERE event_type IN ('view', 'click')
), msg AS (
  SELECT CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_ms,
    CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE CAST(user_id AS VARCHAR) END AS vehicle_id,
    CASE event_type WHEN 'purchase' THEN 'CAM' WHEN 'signup' THEN 'DENM' ELSE 'UNKNOWN' END AS message_type,
    CAST(length(props) + floor(value) AS BIGINT) AS message_size_bytes, CAST(user_id AS VARCHAR) AS sender_id,
    CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS receiver_id,
    CASE WHEN event_id % 5 <> 0 THEN value END AS latency_ms,
    CASE event_id % 3 WHEN 0 THEN 'uplink_to_rsu' WHEN 1 THEN 'downlink_from_rsu' ELSE 'v2v' END AS direction,
    event_id AS ordinal
  FROM events WHERE event_type IN ('purchase', 'signup', 'error')
), fused AS (
  SELECT p.timestamp_ms, p.vehicle_id, p.latitude, p.longitude, p.altitude, p.speed_mps, p.heading_deg, p.ordinal,
    count(m.timestamp_ms) AS messages_sent, CAST(coalesce(sum(m.message_size_bytes), 0) AS BIGINT) AS total_bytes_sent,
    avg(m.latency_ms) AS avg_latency_ms, coalesce(string_agg(DISTINCT m.message_type, ',' ORDER BY m.message_type), '') AS message_types
  FROM pos p LEFT JOIN msg m ON m.vehicle_id = p.vehicle_id
    AND m.timestamp_ms BETWEEN p.timestamp_ms - 3600000 AND p.timestamp_ms + 3600000
  GROUP BY ALL
)
"""
