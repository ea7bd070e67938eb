"""The three runs end to end: profiling, topic documents to result tables, records to trajectories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics, coordinates, filters, fusion, records, trajectory
from ..sources import json_records, side_files, tables


def discover(spark: SparkSession, input_dir: str, sample: int | None = None) -> DataFrame:
    """One row that profiles all JSON files below a folder; files that can't be read count among total_files."""
    files = json_records.read_files(spark, input_dir)
    total = files.select("file").count()
    return records.discovery_summary(json_records.read_objects(files, sample=sample), total, sample=sample)


def topic_entries(files: DataFrame) -> DataFrame:
    """(file, topic, pos, recording_timestamp_nsec, message, size) of the entries of topic documents (file, value); a document that doesn't parse yields nothing."""
    docs = files.select("file", json_records.message_sizes("value").alias("sizes"), F.try_parse_json("value").alias("v"))
    entries = json_records.topic_records(docs.where(F.col("v").isNotNull()), ["file", "sizes"])
    size = F.try_element_at(F.try_element_at("sizes", F.col("topic")), F.col("pos") + 1)
    return entries.select("file", "topic", "pos", "recording_timestamp_nsec", "message", size.alias("size"))


def topic_rows(entries: DataFrame, *, compat: bool = False, demo: bool = False) -> tuple[DataFrame, DataFrame]:
    """Positions and messages of the entries of topic documents, with file and ordinal."""
    ids = analytics.majority_ids(records.entry_ids(entries))
    points = records.topic_positions(entries, ids, compat=compat, demo=demo)
    return points, records.topic_messages(entries, compat=compat, demo=demo)


def topic_tables(points: DataFrame, messages: DataFrame, *, window_ms: int = 1000) -> dict[str, DataFrame]:
    """trajectories, v2x_messages and fused_data of what topic_rows gives."""
    numbered = points.withColumn("ordinal", F.struct("file", "topic", "ordinal"))
    fused = fusion.fuse_topics(numbered, messages, window_ms=window_ms).drop("ordinal")
    return {"trajectories": points.drop("file", "ordinal"), "v2x_messages": messages.drop("file", "ordinal"), "fused_data": fused}


def run_topics(spark: SparkSession, input_dir: str, output_dir: str, *, fmt: str = "parquet", scenario_dirs: Sequence[str] | None = None, mode: str = "scenarios", window_ms: int = 1000) -> DataFrame:
    """Writes the three tables and returns the run's statistics.

    Entries are landed first, so documents are parsed once; positions and messages
    are landed of them, which fusion, results and statistics read.
    """
    if scenario_dirs is None:
        files = json_records.read_files(spark, input_dir, mode=mode)
    else:
        files = json_records.read_files(spark, json_records.scenario_paths(input_dir, scenario_dirs))
    entries = _landed(topic_entries(files), f"{output_dir}/_landed/entries")
    landed = (_landed(df, f"{output_dir}/_landed/{name}") for name, df in zip(("gnss", "v2x"), topic_rows(entries), strict=True))
    found = topic_tables(*landed, window_ms=window_ms)
    for name in ("trajectories", "v2x_messages", "fused_data"):
        tables.write(found[name], f"{output_dir}/{name}.{fmt}", fmt)
    if fmt == "parquet":
        found = {n: tables.read_results(spark, output_dir, n) for n in found}
    return analytics.run_stats(found["trajectories"], found["v2x_messages"], found["fused_data"], files.select("file").count())


@dataclass(frozen=True)
class RecordRun:
    samples: DataFrame
    fused: DataFrame
    origin: coordinates.Origin
    gnss: DataFrame
    messages: DataFrame


def _landed(df: DataFrame, path: str) -> DataFrame:
    """Written as Parquet and read back: JSON is parsed once, and later filters reach the scan."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_records(spark: SparkSession, config: side_files.PipelineConfig, *, step_ms: int = 1000, write: bool = True) -> RecordRun:
    """parse, map ids, filter by region, build trajectories, project, fuse, export."""
    files = json_records.read_files(spark, config.input_dir)
    gnss, messages = records.parse_records(json_records.read_objects(files, sample=config.sample))
    land = lambda df, name: _landed(df, f"{config.output_dir}/_landed/{name}") if write else df
    gnss, messages = land(gnss, "gnss"), land(messages, "v2x")
    if config.ids_map_path:
        ids = side_files.load_identity_map(config.ids_map_path)
        gnss, messages = (side_files.apply_identity_map(x, ids) for x in (gnss, messages))
    cols = filters.Cols(ts="timestamp_utc_ms", lat="latitude_deg", lon="longitude_deg")
    if config.region_bbox:
        gnss = filters.filter_bbox(gnss, config.region_bbox, cols=cols)
    if config.region_polygon_path:
        gnss = filters.filter_polygon_file(gnss, config.region_polygon_path, cols=cols)
    named = gnss.select("vehicle_id", F.col("timestamp_utc_ms").alias("timestamp_ms"), F.col("latitude_deg").alias("latitude"), F.col("longitude_deg").alias("longitude"), F.col("altitude_m").alias("altitude"), "speed_mps", "heading_deg", F.struct("source_file", "ordinal").alias("ordinal"))
    samples = land(trajectory.trajectory_samples(named, step_ms=step_ms, gap_ms=int(config.gap_threshold_s * 1000)), "samples")
    lon0, lat0 = config.origin or (None, None)
    samples, origin = coordinates.project(samples, use_enu=config.use_enu, origin=(lat0, lon0, None if lat0 is None else 0.0))
    fused = land(fusion.fuse_records(samples, messages, tolerance_ms=config.sync_tolerance_ms), "fused")
    if write and config.format == "parquet":
        tables.export_samples(samples, f"{config.output_dir}/trajectories.parquet")
        tables.export_fused(fused, f"{config.output_dir}/fused.parquet")
    elif write:
        tables.export_csv(config.output_dir, samples, fused)
    if write and config.visualize:
        for name, df in plot_tables(samples, fused).items():
            tables.write(df, f"{config.output_dir}/plots/{name}.parquet")
    if write and config.metadata_out:
        facts = tables.metadata(spark, crs="ENU" if config.use_enu else "UTM", origin_lat_deg=origin[0], origin_lon_deg=origin[1], origin_alt_m=origin[2], hz=config.hz, gap_threshold_s=config.gap_threshold_s, sync_tolerance_ms=config.sync_tolerance_ms, input_dir=config.input_dir, output_dir=config.output_dir)
        facts.coalesce(1).write.mode("overwrite").json(config.metadata_out)
    return RecordRun(samples, fused, origin, gnss, messages)


def plot_tables(samples: DataFrame, fused: DataFrame) -> dict[str, DataFrame]:
    """What plots of a run are drawn from: tracks, latency and throughput by place and throughput over time. Drawing is left to other tools."""
    return {
        "tracks": samples.select("vehicle_id", "timestamp_ms", "x_m", "y_m", trajectory.map_class().alias("class")),
        "latency_heatmap": analytics.heatmap(fused, F.col("avg_latency_ms"), "mean", lat="y_m", lon="x_m", over=samples),
        "throughput_heatmap": analytics.heatmap(fused, F.col("tx_bytes") + F.col("rx_bytes"), "sum", lat="y_m", lon="x_m", over=samples),
        "throughput": analytics.throughput_series(fused),
    }


def report(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The standard report over the three written tables, as named DataFrames."""
    points, messages, fused = (tables.read_results(spark, data_dir, n) for n in tables.NAMES)
    rates = analytics.vehicle_rates(fused)
    return {
        "totals": analytics.trajectory_totals(points),
        "extent": analytics.geo_extent(points),
        "message_types": analytics.value_counts(messages),
        "message_sizes": analytics.message_sizes(messages),
        "messages_per_vehicle": analytics.per_vehicle_summary(messages),
        "activity": analytics.active_share(fused),
        "analysis_summary": rates,
        "hourly": analytics.hourly_messages(messages),
        "links": analytics.link_stats(messages),
        "hotspots": analytics.top_k(analytics.grid_stats(fused, active=True), "total_messages", 10, ("lat_cell", "lon_cell")),
    }


def write_report(spark: SparkSession, data_dir: str, out_dir: str | None = None) -> None:
    """analysis_summary, spatial_hotspots and vehicle_statistics as CSV, valid messages as Parquet."""
    out_dir = out_dir or data_dir
    found = report(spark, data_dir)
    messages = tables.read_results(spark, data_dir, "v2x_messages")
    tables.write(found["analysis_summary"], f"{out_dir}/analysis_summary.csv", "csv")
    tables.write(analytics.grid_stats(tables.read_results(spark, data_dir, "fused_data"), active=True), f"{out_dir}/spatial_hotspots.csv", "csv")
    tables.write(analytics.valid_vehicle_stats(messages), f"{out_dir}/vehicle_statistics.csv", "csv")
    tables.write(filters.known_only(messages), f"{out_dir}/v2x_messages_valid.parquet")
