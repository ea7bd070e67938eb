"""Spatial, temporal and value filters over position tables.

Columns are named by Cols, so one operator serves record and topic tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

BBox = tuple[float, float, float, float]
MODES = ("intersect", "contain", "first")


@dataclass(frozen=True)
class Cols:
    vehicle: str = "vehicle_id"
    ts: str = "timestamp_ms"
    lat: str = "latitude"
    lon: str = "longitude"
    order: str = "ordinal"


def valid_bbox(bbox: BBox) -> bool:
    """Longitudes within 180, latitudes within 90, minimum below maximum."""
    w, s, e, n = bbox
    return -180 <= w < e <= 180 and -90 <= s < n <= 90


def keep_where(df: DataFrame, inside: Column, mode: str, cols: Cols = Cols()) -> DataFrame:
    """intersect: rows inside; contain: all rows of vehicles that never leave; first: of vehicles that start inside.

    The vehicle modes aggregate the verdict per vehicle, with partial sums on
    the map side, and semi-join it back, so a vehicle of any number of rows
    never has to fit one window.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: one of {MODES}")
    inside = F.coalesce(inside, F.lit(False))
    if mode == "intersect":
        return df.where(inside)
    if mode == "contain":
        verdict = F.every(inside)
    else:
        verdict = F.min_by(inside, F.struct(cols.ts, cols.order))
    kept = df.groupBy(cols.vehicle).agg(verdict.alias("__in")).where("__in").select(cols.vehicle)
    return df.join(kept, cols.vehicle, "left_semi").select(*df.columns)


def filter_bbox(df: DataFrame, bbox: BBox, mode: str = "intersect", cols: Cols = Cols()) -> DataFrame:
    if not valid_bbox(bbox):
        raise ValueError(f"invalid bounding box {bbox}")
    return keep_where(df, geo.in_bbox(F.col(cols.lat), F.col(cols.lon), bbox), mode, cols)


def filter_polygon(df: DataFrame, ring: list[tuple[float, float]], mode: str = "intersect", cols: Cols = Cols()) -> DataFrame:
    return keep_where(df, geo.in_polygon(F.col(cols.lat), F.col(cols.lon), ring), mode, cols)


def filter_polygon_file(df: DataFrame, path: str, mode: str = "intersect", cols: Cols = Cols()) -> DataFrame:
    from ..sources.side_files import load_geojson_ring

    return filter_polygon(df, load_geojson_ring(path), mode, cols)


def filter_time_range(df: DataFrame, start_ms: int, end_ms: int, ts: str = "timestamp_ms") -> DataFrame:
    return df.where(F.col(ts).between(start_ms, end_ms))


def active_only(df: DataFrame, column: str = "messages_sent") -> DataFrame:
    return df.where(F.col(column) > 0)


def known_only(df: DataFrame, vehicle: str = "vehicle_id") -> DataFrame:
    return df.where(F.col(vehicle) != "unknown")


def for_vehicle(df: DataFrame, vehicle_id: str, vehicle: str = "vehicle_id") -> DataFrame:
    return df.where(F.col(vehicle) == vehicle_id)


def valid_positions(df: DataFrame, cols: Cols = Cols()) -> DataFrame:
    return df.where(geo.valid_coordinates(F.col(cols.lat), F.col(cols.lon)))


def extent(df: DataFrame, cols: Cols = Cols()) -> DataFrame:
    """One row min_lon, min_lat, max_lon, max_lat; nulls for an empty table."""
    return df.agg(
        F.min(cols.lon).alias("min_lon"), F.min(cols.lat).alias("min_lat"), F.max(cols.lon).alias("max_lon"), F.max(cols.lat).alias("max_lat")
    )


def bbox_of(df: DataFrame, cols: Cols = Cols()) -> BBox:
    found = extent(df, cols).first()
    if found["min_lon"] is None:
        raise ValueError("no positions: there is no bounding box")
    return tuple(found)


def unique_vehicles(df: DataFrame, vehicle: str = "vehicle_id") -> DataFrame:
    return df.select(vehicle).distinct().orderBy(vehicle)


def filter_summary(original: DataFrame, filtered: DataFrame | Column, cols: Cols = Cols()) -> DataFrame:
    """One row that compares a table with what a filter left of it; shares are 0 where there is nothing to share.

    filtered is the table that is left, or the condition that rows are kept by,
    which takes one scan. Vehicles are counted by their own rows first.
    """

    def facts(name: str, kept: Column) -> list[Column]:
        box = [f(F.when(kept, F.col(c))).alias(f"{name}_{n}") for n, f, c in (("min_lon", F.min, cols.lon), ("min_lat", F.min, cols.lat), ("max_lon", F.max, cols.lon), ("max_lat", F.max, cols.lat))]
        return [F.count_if(kept).alias(f"{name}_count"), *box]

    def total(rows: DataFrame, name: str) -> list[Column]:
        sums = [F.sum(f"{name}_count").alias(f"{name}_count"), F.count_if((F.col(f"{name}_count") > 0) & F.col(cols.vehicle).isNotNull()).alias(f"{name}_vehicles")]
        return [*(F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(sums, (f"{name}_count", f"{name}_vehicles"), strict=True)), *[f(f"{name}_{n}").alias(f"{name}_{n}") for n, f in (("min_lon", F.min), ("min_lat", F.min), ("max_lon", F.max), ("max_lat", F.max))]]

    if isinstance(filtered, Column):
        rows = original.groupBy(cols.vehicle).agg(*facts("original", F.lit(True)), *facts("filtered", F.coalesce(filtered, F.lit(False))))
        both = rows.agg(*total(rows, "original"), *total(rows, "filtered"))
    else:
        sides = [df.groupBy(cols.vehicle).agg(*facts(n, F.lit(True))) for df, n in ((original, "original"), (filtered, "filtered"))]
        both = sides[0].agg(*total(sides[0], "original")).join(sides[1].agg(*total(sides[1], "filtered")))  # one row each
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a) * 100.0, F.col(b)), F.lit(0.0))
    lost = F.when(F.col("original_count") > 0, 100.0 - share("filtered_count", "original_count")).otherwise(0.0)
    return both.withColumn("reduction_pct", F.bround(lost, 2)).withColumn(
        "vehicle_retention_pct", F.bround(share("filtered_vehicles", "original_vehicles"), 2)
    )


def summary_dict(row: Any) -> dict[str, Any]:
    """A filter_summary row as nested values with bounding boxes as tuples."""
    sides = ("min_lon", "min_lat", "max_lon", "max_lat")
    out = {k: v for k, v in row.asDict().items() if not k.endswith(sides)}
    for name in ("original", "filtered"):
        box = tuple(row[f"{name}_{s}"] for s in sides)
        out[f"{name}_bbox"] = None if box[0] is None else box
    return out
