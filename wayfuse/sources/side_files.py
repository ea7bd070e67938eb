"""Small files that the driver reads: configuration, identity map, roadside units, polygons."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import BBox, valid_bbox


@dataclass(frozen=True)
class PipelineConfig:
    """Options of a run; a bad value is a ValueError on construction."""

    input_dir: str
    output_dir: str
    region_bbox: BBox | None = None
    region_polygon_path: str | None = None
    origin: tuple[float, float] | None = None
    hz: int = 1
    sync_tolerance_ms: int = 500
    format: str = "parquet"
    visualize: bool = False
    gap_threshold_s: float = 5.0
    use_enu: bool = True
    ids_map_path: str | None = None
    rsu_ids_path: str | None = None
    metadata_out: str | None = None
    sample: int | None = None
    workers: int | None = None
    scenario_dirs: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        def need(ok: bool, what: str) -> None:
            if not ok:
                raise ValueError(what)

        put = lambda name, value: object.__setattr__(self, name, value)
        for name in ("input_dir", "output_dir", "region_polygon_path", "ids_map_path", "rsu_ids_path", "metadata_out"):
            if (value := getattr(self, name)) is not None:
                put(name, os.path.expanduser(str(value)))
        if self.region_bbox is not None:
            put("region_bbox", tuple(float(x) for x in self.region_bbox))
            need(len(self.region_bbox) == 4 and valid_bbox(self.region_bbox), f"invalid region_bbox {self.region_bbox}")
        if self.scenario_dirs is not None:
            put("scenario_dirs", tuple(str(x) for x in self.scenario_dirs))
        if self.origin is not None:
            put("origin", tuple(float(x) for x in self.origin))
        put("format", str(self.format).lower())
        need(self.format in ("parquet", "csv"), f"format {self.format!r} is neither parquet nor csv")
        need(1 <= self.hz <= 100, "hz must lie in 1..100")
        need(self.sync_tolerance_ms >= 0, "sync_tolerance_ms must not be negative")
        need(self.gap_threshold_s >= 0, "gap_threshold_s must not be negative")
        need(self.sample is None or self.sample >= 1, "sample must be at least 1")
        need(self.workers is None or self.workers >= 1, "workers must be at least 1")


def config_from(values: Mapping[str, Any]) -> PipelineConfig:
    """Unknown names are an error."""
    known = {f.name for f in fields(PipelineConfig)}
    if extra := set(values) - known:
        raise ValueError(f"unknown options: {sorted(extra)}")
    return PipelineConfig(**values)


def load_config(path: str) -> PipelineConfig:
    """YAML or JSON."""
    import yaml

    if not Path(path).exists():
        raise FileNotFoundError(path)
    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping of options")
    return config_from(found)


def _json_object(path: str) -> dict[str, Any]:
    if not Path(path).exists():
        raise FileNotFoundError(path)
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no JSON object")
    return found


def load_identity_map(path: str) -> dict[str, str]:
    return {str(k): str(v) for k, v in _json_object(path).items()}


def load_rsu_ids(path: str) -> dict[str, dict[str, Any]]:
    return _json_object(path)


def apply_identity_map(df: DataFrame, ids: Mapping[str, str] | DataFrame, *, column: str = "vehicle_id") -> DataFrame:
    """Replaces ids by their canonical form; ids that are not in the map stay.

    A map given as a table (raw_id, canonical_id) is joined as the planner sees
    fit; one read by the driver is in its memory already and small.
    """
    table = ids if isinstance(ids, DataFrame) else df.sparkSession.createDataFrame(list(ids.items()) or [("", "")], "raw_id string, canonical_id string")
    joined = df.join(table, df[column] == table["raw_id"], "left")
    return joined.withColumn(column, F.coalesce("canonical_id", column)).drop("raw_id", "canonical_id")


def rsu_table(spark: SparkSession, rsus: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    rows = [(str(k), (v.get("location") or {}).get("lat"), (v.get("location") or {}).get("lon"), json.dumps(v)) for k, v in rsus.items()]
    return spark.createDataFrame(rows, "rsu_id string, rsu_lat double, rsu_lon double, rsu_metadata string")


def with_rsus(messages: DataFrame, rsus: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    return messages.join(rsu_table(messages.sparkSession, rsus), "rsu_id", "left")


def geojson_ring(found: Mapping[str, Any]) -> list[tuple[float, float]]:
    """Outer ring of the first polygon: of the first feature of a collection, of a feature, or of a geometry. Holes are ignored."""
    kind = found.get("type")
    if kind == "FeatureCollection":
        if not found.get("features"):
            raise ValueError("the feature collection is empty")
        return geojson_ring(found["features"][0])
    if kind == "Feature":
        return geojson_ring(found.get("geometry") or {})
    rings = {"Polygon": lambda c: c, "MultiPolygon": lambda c: c[0] if c else []}.get(kind)
    if rings is None:
        raise ValueError(f"GeoJSON type {kind!r} holds no polygon")
    outer = rings(found.get("coordinates") or [])
    if not outer or len(outer[0]) < 4:
        raise ValueError("the polygon has no ring")
    return [(float(p[0]), float(p[1])) for p in outer[0]]


def load_geojson_ring(path: str) -> list[tuple[float, float]]:
    return geojson_ring(_json_object(path))
