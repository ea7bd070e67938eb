"""Geodesy as column expressions: ENU, UTM both ways, distances, grid cells, polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84, and the mean radius of the haversine formula.
A, INV_F, EARTH_RADIUS_M = 6378137.0, 298.257223563, 6371000.0
FLAT = 1 / INV_F
E2 = FLAT * (2 - FLAT)
K0, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """Rectifying radius, the forward and inverse coefficients of the sixth-order series in n, and those from conformal to geodetic latitude."""
    n = FLAT / (2 - FLAT)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    # Krueger's published series, powers of n from the first.
    alpha = [
        [1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800],
        [0, 13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360],
        [0, 0, 61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440],
        [0, 0, 0, 49561 / 161280, -179 / 168, 6601661 / 7257600],
        [0, 0, 0, 0, 34729 / 80640, -3418889 / 1995840],
        [0, 0, 0, 0, 0, 212378941 / 319334400],
    ]
    beta = [
        [1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800],
        [0, 1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720],
        [0, 0, 17 / 480, -37 / 840, -209 / 4480, 5569 / 90720],
        [0, 0, 0, 4397 / 161280, -11 / 504, -830251 / 7257600],
        [0, 0, 0, 0, 4583 / 161280, -108847 / 3991680],
        [0, 0, 0, 0, 0, 20648693 / 638668800],
    ]
    delta = [
        [2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675],
        [0, 7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945],
        [0, 0, 56 / 15, -136 / 35, -1262 / 105, 73814 / 2835],
        [0, 0, 0, 4279 / 630, -332 / 35, -399572 / 14175],
        [0, 0, 0, 0, 4174 / 315, -144838 / 6237],
        [0, 0, 0, 0, 0, 601676 / 22275],
    ]
    total = lambda rows: [sum(c * n ** (i + 1) for i, c in enumerate(r)) for r in rows]
    return radius, total(alpha), total(beta), total(delta)


RADIUS, ALPHA, BETA, DELTA = _series()


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def _ecef(lat: Column, lon: Column, alt: Column) -> tuple[Column, Column, Column]:
    p, q = F.radians(lat), F.radians(lon)
    normal = F.lit(A) / F.sqrt(F.lit(1.0) - F.lit(E2) * F.pow(F.sin(p), 2))
    flat = (normal + alt) * F.cos(p)
    return flat * F.cos(q), flat * F.sin(q), (normal * F.lit(1 - E2) + alt) * F.sin(p)


def enu(lat: Column, lon: Column, alt: Column, lat0: Column, lon0: Column, alt0: Column) -> tuple[Column, Column, Column]:
    """East, north and up in metres of a position as seen from an origin; a null altitude is 0."""
    alt, alt0 = F.coalesce(alt, F.lit(0.0)), F.coalesce(alt0, F.lit(0.0))
    dx, dy, dz = (a - b for a, b in zip(_ecef(lat, lon, alt), _ecef(lat0, lon0, alt0), strict=True))
    p, q = F.radians(lat0), F.radians(lon0)
    across = F.cos(q) * dx + F.sin(q) * dy
    return F.cos(q) * dy - F.sin(q) * dx, F.cos(p) * dz - F.sin(p) * across, F.cos(p) * across + F.sin(p) * dz


def utm_zone(lon: Column) -> Column:
    """1 to 60; 180 degrees east belongs to zone 60."""
    return F.least(((lon + 180) / 6).cast("int") + 1, F.lit(60))


def utm_forward(lat: Column, lon: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    e = math.sqrt(E2)
    p, d = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(p)
    t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
    xi, eta = F.atan2(t, F.cos(d)), F.asinh(F.sin(d) / F.sqrt(F.pow(t, 2) + F.pow(F.cos(d), 2)))
    north, east = xi, eta
    for j, a in enumerate(ALPHA, 1):
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    scale = F.lit(K0 * RADIUS)
    return F.lit(FALSE_EASTING) + scale * east, scale * north + F.when(south, FALSE_NORTHING).otherwise(0.0)


def utm_inverse(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees."""
    scale = F.lit(K0 * RADIUS)
    xi0 = (north - F.when(south, FALSE_NORTHING).otherwise(0.0)) / scale
    eta0 = (east - FALSE_EASTING) / scale
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - F.lit(b) * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - F.lit(b) * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.atan2(F.sin(xi), F.sqrt(F.pow(F.sinh(eta), 2) + F.pow(F.cos(xi), 2)))
    lat = chi
    for j, c in enumerate(DELTA, 1):  # a series, since each step of an iteration would repeat the expression before it
        lat = lat + F.lit(c) * F.sin(2 * j * chi)
    return F.degrees(lat), F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + (zone * 6 - 183)


def grid_cell(value: Column, size: float) -> Column:
    """Index of the grid cell; truncates toward zero, so cell 0 is twice as wide."""
    return (value / F.lit(size)).cast("bigint")


def valid_coordinates(lat: Column, lon: Column) -> Column:
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def in_bbox(lat: Column, lon: Column, bbox: tuple[float, float, float, float]) -> Column:
    """Bounds (min_lon, min_lat, max_lon, max_lat) inclusive."""
    return lon.between(bbox[0], bbox[2]) & lat.between(bbox[1], bbox[3])


def in_polygon(lat: Column, lon: Column, ring: list[tuple[float, float]]) -> Column:
    """Strictly inside a ring of (lon, lat): even-odd crossing count, points on an edge excluded, bounding box first."""
    ring = ring if ring[0] == ring[-1] else [*ring, ring[0]]
    xs, ys = [x for x, _ in ring], [y for _, y in ring]
    crossings, on_edge = F.lit(0), F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
        area = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
        within = lon.between(min(x1, x2), max(x1, x2)) & lat.between(min(y1, y2), max(y1, y2))
        on_edge = on_edge | ((area == 0) & within)
        if y1 != y2:
            crosses = (lat >= min(y1, y2)) & (lat < max(y1, y2)) & ((area < 0) if y2 > y1 else (area > 0))
            crossings = crossings + F.when(crosses, 1).otherwise(0)
    return in_bbox(lat, lon, (min(xs), min(ys), max(xs), max(ys))) & (crossings % 2 == 1) & ~on_edge
