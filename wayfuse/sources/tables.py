"""Result tables: reading them back, and writing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.analytics import type_counts_wide

NAMES = ("trajectories", "v2x_messages", "fused_data")


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


# The columns of each table.
GNSS = "vehicle_id string, timestamp_utc_ms bigint, latitude_deg double, longitude_deg double, altitude_m double, speed_mps double, heading_deg double, station_id string, station_type string, source_file string"
V2X = "vehicle_id string, station_id string, station_type string, timestamp_utc_ms bigint, tx_timestamp_utc_ms bigint, rx_timestamp_utc_ms bigint, direction string, rsu_id string, message_type string, payload_bytes bigint, frame_bytes bigint, latency_ms double, source_file string"
TRAJECTORIES = "timestamp_ms bigint, vehicle_id string, latitude double, longitude double, altitude double, speed_mps double, heading_deg double, topic string"
MESSAGES = "timestamp_ms bigint, vehicle_id string, message_type string, message_size_bytes bigint, sender_id string, receiver_id string, latency_ms double, rssi_dbm double, topic string"
FUSED = "timestamp_ms bigint, vehicle_id string, latitude double, longitude double, altitude double, speed_mps double, heading_deg double, messages_sent bigint, total_bytes_sent bigint, avg_latency_ms double, message_types string"
METADATA = "crs string, origin_lat_deg double, origin_lon_deg double, origin_alt_m double, hz int, gap_threshold_s double, sync_tolerance_ms int, input_dir string, output_dir string, notes string"


def read_results(spark: SparkSession, data_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    found = spark.read.parquet(f"{data_dir}/{name}.parquet")
    return found.select(*columns) if columns else found


def write(df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet or CSV with a header, a folder of part files."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"format {fmt!r} is neither parquet nor csv")
    out = df.write.mode(mode)
    out = out.partitionBy(*partition_by) if partition_by else out
    out.parquet(path) if fmt == "parquet" else out.option("header", True).csv(path)


def write_results(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    for name, df in tables.items():
        write(df, f"{out_dir}/{name}.{fmt}", fmt)


def flat_samples(samples: DataFrame) -> DataFrame:
    """Trajectory samples with the quality flags as columns."""
    flags = [F.col(f"quality.{q}").alias(f"quality_{q}") for q in ("gap", "extrapolated", "low_speed")]
    return samples.select("vehicle_id", "timestamp_ms", "lat_deg", "lon_deg", "alt_m", "x_m", "y_m", "speed_mps", "heading_deg", *flags)


def export_samples(samples: DataFrame, path: str) -> bool:
    """Writes Parquet unless there is nothing to write."""
    return _export(flat_samples(samples), path)


def export_fused(fused: DataFrame, path: str, types: Sequence[str] | None = None) -> bool:
    """Fused records with one count column per message type."""
    return _export(type_counts_wide(fused, types), path)


def _export(df: DataFrame, path: str) -> bool:
    if df.isEmpty():
        return False
    write(df, path)
    return True


def export_csv(out_dir: str, samples: DataFrame | None = None, fused: DataFrame | None = None) -> None:
    """The reduced columns that the CSV files have."""
    if samples is not None and not samples.isEmpty():
        write(samples.select("vehicle_id", "timestamp_ms", "lat_deg", "lon_deg", "x_m", "y_m"), f"{out_dir}/trajectories.csv", "csv")
    if fused is not None and not fused.isEmpty():
        write(fused.select("vehicle_id", "timestamp_ms", "x_m", "y_m", "tx_bytes", "rx_bytes"), f"{out_dir}/fused.csv", "csv")


def metadata(spark: SparkSession, **values) -> DataFrame:
    """One row of run metadata; missing values are null."""
    schema = _schema(METADATA)
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)
