"""Projection of trajectory samples to local or UTM coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .analytics import quantiles

Origin = tuple[float, float, float]
METHODS = ("first", "centroid", "median")


def origin_table(samples: DataFrame, method: str = "first", *, order: tuple[str, ...] = ("vehicle_id", "timestamp_ms")) -> DataFrame:
    """One row (lat, lon, alt); a missing altitude counts as 0. The first sample is the first by order."""
    alt = F.coalesce("alt_m", F.lit(0.0))
    if method == "first":
        found = samples.agg(F.min_by(F.struct("lat_deg", "lon_deg", alt.alias("alt")), F.struct(*order)).alias("o"))
        return found.select(F.col("o.lat_deg").alias("lat"), F.col("o.lon_deg").alias("lon"), F.col("o.alt").alias("alt"))
    if method not in METHODS:
        raise ValueError(f"unknown origin method {method!r}: one of {METHODS}")
    names = {"lat": F.col("lat_deg"), "lon": F.col("lon_deg"), "alt": alt}
    if method == "centroid":
        return samples.agg(*[F.avg(c).alias(n) for n, c in names.items()])
    own = samples.select(*[c.alias(n) for n, c in names.items()])
    middle = [(quantiles(own, n, [0.5])[0]) for n in names]
    return samples.sparkSession.createDataFrame([tuple(middle)], "lat double, lon double, alt double")


def select_origin(samples: DataFrame, method: str = "first", **kwargs) -> Origin:
    found = origin_table(samples, method, **kwargs).first()
    if found is None or found["lat"] is None:
        raise ValueError("no samples to choose an origin from")
    return found["lat"], found["lon"], found["alt"]


def to_enu(samples: DataFrame, lat0: float, lon0: float, alt0: float = 0.0) -> DataFrame:
    """Fills x_m (east) and y_m (north); altitudes stay."""
    east, north, _ = geo.enu(F.col("lat_deg"), F.col("lon_deg"), F.col("alt_m"), F.lit(lat0), F.lit(lon0), F.lit(alt0))
    return samples.withColumns({"x_m": east, "y_m": north})


def to_utm(samples: DataFrame, lat0: float | None = None, lon0: float | None = None, *, order: tuple[str, ...] = ("vehicle_id", "timestamp_ms")) -> DataFrame:
    """Fills x_m and y_m with UTM easting and northing in one zone: the origin's, relative to it, or else the first sample's, absolute."""
    given = lat0 is not None and lon0 is not None
    if not given:
        lat0, lon0, _ = select_origin(samples, "first", order=order)
    zone, south = geo.utm_zone(F.lit(lon0)), F.lit(lat0) < 0
    east, north = geo.utm_forward(F.col("lat_deg"), F.col("lon_deg"), zone, south)
    if given:
        east0, north0 = geo.utm_forward(F.lit(lat0), F.lit(lon0), zone, south)
        east, north = east - east0, north - north0
    return samples.withColumns({"x_m": east, "y_m": north})


def project(
    samples: DataFrame, *, use_enu: bool = True, origin: tuple[float | None, float | None, float | None] = (None, None, None), auto: str = "first", order: tuple[str, ...] = ("vehicle_id", "timestamp_ms")
) -> tuple[DataFrame, Origin]:
    """Projects all vehicles to one origin; parts of it that are not given come from the samples. Without samples it is (0, 0, 0)."""
    lat0, lon0, alt0 = origin
    if lat0 is None or lon0 is None:
        found = origin_table(samples, auto, order=order).first()
        if found is None or found["lat"] is None:
            return samples, (0.0, 0.0, 0.0)
        lat0 = found["lat"] if lat0 is None else lat0
        lon0 = found["lon"] if lon0 is None else lon0
        alt0 = found["alt"] if alt0 is None else alt0
    alt0 = 0.0 if alt0 is None else alt0
    return (to_enu(samples, lat0, lon0, alt0) if use_enu else to_utm(samples, lat0, lon0)), (lat0, lon0, alt0)
