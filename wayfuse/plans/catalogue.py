"""Named queries over the test tables, each with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, savgol, scalars
from ..operators import analytics as an
from ..operators import coordinates, filters, fusion, trajectory
from ..sources import side_files, tables
from . import adapters
from .adapters import SQL, messages, positions, samples, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Parameters that suit the event stream, whose vehicles report every few hours.
GAP_MS, STEP_MS, WINDOW_MS, TOLERANCE_MS = 86_400_000, 3_600_000, 7_200_000, 3_600_000
BBOX = (6.2, 50.2, 6.8, 50.9)
RING = [(6.1, 50.1), (6.9, 50.2), (6.7, 50.8), (6.4, 50.5), (6.2, 50.9), (6.1, 50.1)]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql if sql.lstrip().upper().startswith("WITH") else SQL + sql
        return fn

    return put


def rounded(df: DataFrame, n: int = 6) -> DataFrame:
    """Doubles to n places; -0.0 to 0.0."""
    return df.select(*[(F.round(c, n) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def filled(column: str) -> Column:
    """-1 for null, where results are compared by tools that tell integers with nulls from integers."""
    return F.coalesce(column, F.lit(-1)).cast("bigint").alias(column)


def fused(spark: SparkSession, d: str) -> DataFrame:
    return fusion.fuse_topics(positions(spark, d), messages(spark, d), window_ms=WINDOW_MS)


def rnd(expr: str, name: str | None = None, n: int = 6) -> str:
    return f"round({expr}, {n}) + 0.0 AS {name or expr}"


# --- fusion ---------------------------------------------------------------


@query(f"SELECT ordinal, vehicle_id, timestamp_ms, messages_sent, total_bytes_sent, {rnd('avg_latency_ms')}, message_types FROM fused")
def fuse_topic(spark, d):
    return rounded(fused(spark, d).select("ordinal", "vehicle_id", "timestamp_ms", "messages_sent", "total_bytes_sent", "avg_latency_ms", "message_types"))


@query(
    """SELECT vehicle_id, count(*) AS points, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms,
  CAST(sum(messages_sent) AS BIGINT) AS messages_sent, CAST(sum(total_bytes_sent) AS BIGINT) AS total_bytes_sent,
  round((max(timestamp_ms) - min(timestamp_ms)) / 60000.0::DOUBLE, 6) + 0.0 AS duration_min,
  round(CAST(sum(total_bytes_sent) AS DOUBLE) * 8 / 1000.0 / nullif((max(timestamp_ms) - min(timestamp_ms)) / 60000.0::DOUBLE * 60, 0) * 1e6, 6) AS data_rate_ubps
FROM fused GROUP BY vehicle_id"""
)
def vehicle_comm_stats(spark, d):
    found = an.vehicle_rates(fused(spark, d)).withColumn("data_rate_ubps", F.round(F.col("data_rate_kbps") * 1e6, 6))
    return rounded(found.drop("data_rate_kbps"))


@query(
    """, near AS (SELECT p.ordinal, p.vehicle_id, p.timestamp_ms, m.* EXCLUDE (vehicle_id, timestamp_ms, ordinal), m.ordinal AS mo FROM pos p LEFT JOIN msg m
  ON m.vehicle_id = p.vehicle_id AND m.timestamp_ms BETWEEN p.timestamp_ms - 3600000 AND p.timestamp_ms + 3600000)
SELECT vehicle_id, timestamp_ms,
  CAST(coalesce(sum(message_size_bytes) FILTER (direction = 'uplink_to_rsu'), 0) AS BIGINT) AS tx_bytes,
  CAST(coalesce(sum(message_size_bytes) FILTER (direction = 'downlink_from_rsu'), 0) AS BIGINT) AS rx_bytes,
  round(avg(latency_ms), 6) + 0.0 AS avg_latency_ms,
  count(*) FILTER (message_type = 'CAM') AS msg_count_CAM, count(*) FILTER (message_type = 'DENM') AS msg_count_DENM,
  count(*) FILTER (message_type = 'UNKNOWN') AS msg_count_UNKNOWN
FROM near GROUP BY vehicle_id, timestamp_ms"""
)
def fuse_record_metrics(spark, d):
    side = messages(spark, d).select("vehicle_id", F.col("timestamp_ms").alias("timestamp_utc_ms"), "message_type", F.col("message_size_bytes").alias("payload_bytes"), "direction", "latency_ms")
    found = fusion.fuse_records(samples(spark, d), side, tolerance_ms=TOLERANCE_MS)
    return rounded(an.type_counts_wide(found, an.message_types(side)).drop("x_m", "y_m"))


_NEAREST = """, back AS (SELECT m.ordinal, max(struct_pack(t := p.timestamp_ms, o := p.ordinal)) AS b FROM msg m JOIN pos p
  ON p.vehicle_id = m.vehicle_id AND p.timestamp_ms BETWEEN m.timestamp_ms - 3600000 AND m.timestamp_ms GROUP BY 1),
ahead AS (SELECT m.ordinal, min(struct_pack(t := p.timestamp_ms, o := p.ordinal)) AS a FROM msg m JOIN pos p
  ON p.vehicle_id = m.vehicle_id AND p.timestamp_ms BETWEEN m.timestamp_ms AND m.timestamp_ms + 3600000 GROUP BY 1),
best AS (SELECT m.ordinal, m.vehicle_id, m.timestamp_ms,
  CASE WHEN b IS NULL THEN a WHEN a IS NULL OR m.timestamp_ms - b.t <= a.t - m.timestamp_ms THEN b ELSE a END AS x
  FROM msg m LEFT JOIN back USING (ordinal) LEFT JOIN ahead USING (ordinal))"""


@query(_NEAREST + " SELECT best.ordinal, best.vehicle_id, best.timestamp_ms, coalesce(x.t, -1) AS match_ts, p.latitude, p.longitude FROM best LEFT JOIN pos p ON p.ordinal = x.o")
def asof_nearest(spark, d):
    found = fusion.nearest_join(messages(spark, d), positions(spark, d), tolerance_ms=TOLERANCE_MS, take=("latitude", "longitude"))
    return found.select("ordinal", "vehicle_id", "timestamp_ms", filled("match_ts"), "latitude", "longitude")


@query(_NEAREST + " SELECT count(*) AS total, count(x) AS matched, round(count(x) / count(*)::DOUBLE, 6) AS match_rate FROM best")
def asof_match_rate(spark, d):
    return rounded(fusion.match_rate(fusion.nearest_join(messages(spark, d), positions(spark, d), tolerance_ms=TOLERANCE_MS)))


@query(
    """, k AS (SELECT * FROM pos WHERE ordinal % 2 = 0), u AS (SELECT * FROM pos WHERE ordinal % 2 = 1),
pairs AS (SELECT u.ordinal, k.vehicle_id AS matched_id, abs(u.timestamp_ms - k.timestamp_ms) AS dt_ms,
  2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(k.latitude - u.latitude) / 2), 2) + cos(radians(u.latitude)) * cos(radians(k.latitude)) * pow(sin(radians(k.longitude - u.longitude) / 2), 2)))) AS dist_m
  FROM u JOIN k ON k.timestamp_ms BETWEEN u.timestamp_ms - 1800000 AND u.timestamp_ms + 1800000),
r AS (SELECT *, row_number() OVER (PARTITION BY ordinal ORDER BY dt_ms, dist_m, matched_id) AS rn FROM pairs WHERE dist_m < 20000)
SELECT u.ordinal, r.matched_id, coalesce(r.dt_ms, -1) AS dt_ms, round(r.dist_m, 4) AS dist_m FROM u LEFT JOIN r ON r.ordinal = u.ordinal AND rn = 1"""
)
def spatiotemporal_match(spark, d):
    p = positions(spark, d)
    found = fusion.spatiotemporal_match(p.where("ordinal % 2 = 1"), p.where("ordinal % 2 = 0"), max_ms=1_800_000, max_m=20_000.0)
    return rounded(found.select("ordinal", "matched_id", filled("dt_ms"), "dist_m"), 4)


# --- filters --------------------------------------------------------------

_IN = f"(longitude BETWEEN {BBOX[0]} AND {BBOX[2]} AND latitude BETWEEN {BBOX[1]} AND {BBOX[3]})"
#: Nearly all positions, but for a notch.
NOTCHED = [(5.9, 49.9), (7.1, 49.9), (7.1, 51.1), (6.59371, 51.1), (6.50113, 50.90337), (6.40239, 51.1), (5.9, 51.1), (5.9, 49.9)]


def _poly(ring) -> str:
    edges = ", ".join(f"({x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True))
    return f""", e(x1, y1, x2, y2) AS (VALUES {edges}),
inside AS (SELECT p.ordinal, sum(CASE WHEN (y1 > latitude) <> (y2 > latitude) AND longitude < (x2 - x1) * (latitude - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
  AND NOT bool_or((longitude - x1) * (y2 - y1) = (latitude - y1) * (x2 - x1) AND longitude BETWEEN least(x1, x2) AND greatest(x1, x2) AND latitude BETWEEN least(y1, y2) AND greatest(y1, y2)) AS i
  FROM pos p CROSS JOIN e GROUP BY p.ordinal), pi AS (SELECT pos.*, i FROM pos JOIN inside USING (ordinal))"""


_KEEP = {
    "intersect": "SELECT ordinal, vehicle_id FROM {t} WHERE {i}",
    "contain": "SELECT ordinal, vehicle_id FROM {t} WHERE vehicle_id IN (SELECT vehicle_id FROM {t} GROUP BY 1 HAVING bool_and({i}))",
    "first": "SELECT ordinal, vehicle_id FROM {t} WHERE vehicle_id IN (SELECT vehicle_id FROM (SELECT vehicle_id, {i} AS f, row_number() OVER (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal) AS rn FROM {t}) WHERE rn = 1 AND f)",
}
_WIDE = (6.0, 50.05, 6.9995, 50.99)


def _filter_queries() -> None:
    for mode, sql in _KEEP.items():
        box = _WIDE if mode == "contain" else BBOX
        inside = f"(longitude BETWEEN {box[0]} AND {box[2]} AND latitude BETWEEN {box[1]} AND {box[3]})"

        def bbox(spark, d, mode=mode, box=box):
            return filters.filter_bbox(positions(spark, d), box, mode).select("ordinal", "vehicle_id")

        ring = NOTCHED if mode == "contain" else RING

        def polygon(spark, d, mode=mode, ring=ring):
            return filters.filter_polygon(positions(spark, d), ring, mode).select("ordinal", "vehicle_id")

        bbox.__name__, polygon.__name__ = f"bbox_{mode}", f"polygon_{mode}"
        query(sql.format(t="pos", i=inside))(bbox)
        query(_poly(ring) + sql.format(t="pi", i="i"))(polygon)


_filter_queries()


@query(
    f""", f AS (SELECT * FROM pos WHERE {_IN}), o AS (SELECT count(*) AS oc, count(DISTINCT vehicle_id) AS ov, min(longitude) AS a, min(latitude) AS b, max(longitude) AS c, max(latitude) AS e FROM pos),
g AS (SELECT count(*) AS fc, count(DISTINCT vehicle_id) AS fv, min(longitude) AS a, min(latitude) AS b, max(longitude) AS c, max(latitude) AS e FROM f)
SELECT oc AS original_count, ov AS original_vehicles, o.a AS original_min_lon, o.b AS original_min_lat, o.c AS original_max_lon, o.e AS original_max_lat,
  fc AS filtered_count, fv AS filtered_vehicles, g.a AS filtered_min_lon, g.b AS filtered_min_lat, g.c AS filtered_max_lon, g.e AS filtered_max_lat,
  round(CASE WHEN oc > 0 THEN 100 - fc * 100.0::DOUBLE / oc ELSE 0 END, 2) AS reduction_pct, round(coalesce(fv * 100.0::DOUBLE / nullif(ov, 0), 0), 2) AS vehicle_retention_pct FROM o, g"""
)
def filter_summary(spark, d):
    p = positions(spark, d)
    return rounded(filters.filter_summary(p, geo.in_bbox(F.col("latitude"), F.col("longitude"), BBOX)))


@query(ORACLE["filter_summary"])
def filter_summary_tables(spark, d):
    p = positions(spark, d)
    return rounded(filters.filter_summary(p, filters.filter_bbox(p, BBOX)))


@query("SELECT ordinal FROM fused WHERE messages_sent > 0")
def active_rows(spark, d):
    return filters.active_only(fused(spark, d)).select("ordinal")


@query("SELECT ordinal, vehicle_id FROM msg WHERE vehicle_id <> 'unknown'")
def known_messages(spark, d):
    return filters.known_only(messages(spark, d)).select("ordinal", "vehicle_id")


@query("SELECT ordinal, timestamp_ms FROM pos WHERE timestamp_ms BETWEEN 1704500000000 AND 1705500000000")
def time_range(spark, d):
    return filters.filter_time_range(positions(spark, d), 1704500000000, 1705500000000).select("ordinal", "timestamp_ms")


@query("SELECT ordinal, timestamp_ms, latitude, longitude FROM pos WHERE vehicle_id = '7'")
def one_vehicle(spark, d):
    return filters.for_vehicle(positions(spark, d), "7").select("ordinal", "timestamp_ms", "latitude", "longitude")


@query("SELECT ordinal FROM pos WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180")
def valid_coordinates(spark, d):
    return filters.valid_positions(positions(spark, d)).select("ordinal")


@query("SELECT DISTINCT vehicle_id FROM pos")
def unique_vehicles(spark, d):
    return filters.unique_vehicles(positions(spark, d))


@query("SELECT min(longitude) AS min_lon, min(latitude) AS min_lat, max(longitude) AS max_lon, max(latitude) AS max_lat FROM pos")
def position_bbox(spark, d):
    return filters.extent(positions(spark, d))


# --- trajectories ---------------------------------------------------------

_GAPS = f""", l AS (SELECT *, lag(timestamp_ms) OVER w AS pt, lead(timestamp_ms) OVER w AS nt, row_number() OVER w AS rn, count(*) OVER (PARTITION BY vehicle_id) AS total
  FROM pos WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal)),
g AS (SELECT *, coalesce(timestamp_ms - pt > {GAP_MS}, false) AS gap_before, coalesce(nt - timestamp_ms > {GAP_MS}, false) AS gap_after FROM l),
s AS (SELECT *, CAST(sum(CAST(gap_before AS BIGINT)) OVER (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal) AS BIGINT) AS segment FROM g)"""


@query(_GAPS + " SELECT ordinal, vehicle_id, gap_before, gap_after, gap_before OR gap_after AS at_gap, segment FROM s")
def gap_segments(spark, d):
    return trajectory.with_gaps(positions(spark, d), gap_ms=GAP_MS).select("ordinal", "vehicle_id", "gap_before", "gap_after", "at_gap", "segment")


@query(_GAPS + " SELECT vehicle_id, rn - 1 AS start_index, timestamp_ms AS start_ms, nt AS end_ms FROM s WHERE gap_after")
def gap_list(spark, d):
    return trajectory.gaps(positions(spark, d), gap_ms=GAP_MS)


def _smooth_sql() -> str:
    size, weights = 7, savgol.hat_matrix(7, 2)
    half, cases = 3, {}
    for name in trajectory.SMOOTHED:
        term = lambda row: " + ".join(f"({float(weights[row, j])!r}::DOUBLE * {'lag' if j < row else 'lead'}({name}, {abs(j - row)}) OVER w)" if j != row else f"({float(weights[row, j])!r}::DOUBLE * {name})" for j in range(size))  # noqa: B023, E731
        when = f"CASE WHEN total < {size} OR n < {size} OR gap_after THEN {name}"
        for i in range(half):
            when += f" WHEN i = {i} THEN {term(i)} WHEN i = n - 1 - {i} THEN {term(size - 1 - i)}"
        cases[name] = when + f" ELSE {term(half)} END AS {name}"
    return (
        _GAPS
        + f""", q AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY vehicle_id, segment, gap_after) AS n FROM s WINDOW w AS (PARTITION BY vehicle_id, segment, gap_after ORDER BY timestamp_ms, ordinal)),
sm AS (SELECT vehicle_id, timestamp_ms, ordinal, speed_mps, heading_deg, {", ".join(cases.values())} FROM q WINDOW w AS (PARTITION BY vehicle_id, segment, gap_after ORDER BY timestamp_ms, ordinal))"""
    )


_SMOOTH = _smooth_sql()


@query(_SMOOTH + f" SELECT ordinal, vehicle_id, {rnd('latitude')}, {rnd('longitude')}, {rnd('altitude')} FROM sm")
def smooth_savgol(spark, d):
    found = trajectory.smooth(positions(spark, d), gap_ms=GAP_MS)
    return rounded(found.select("ordinal", "vehicle_id", "latitude", "longitude", "altitude"))


def _resample_sql(source: str) -> str:
    nexts = ", ".join(f"lead({v}) OVER w AS n_{v}" for v in trajectory.VALUES)
    value = lambda v: f"CASE WHEN g = t THEN {v} ELSE {v} + (n_{v} - {v}) * (g - t) / CAST(u - t AS DOUBLE) END AS {v}"
    return f""", a AS (SELECT vehicle_id, timestamp_ms AS t, {", ".join(trajectory.VALUES)}, {nexts}, lead(timestamp_ms) OVER w AS u, min(timestamp_ms) OVER (PARTITION BY vehicle_id) AS t0, ordinal,
  coalesce(timestamp_ms - lag(timestamp_ms) OVER w > {GAP_MS}, false) AS gb, coalesce(lead(timestamp_ms) OVER w - timestamp_ms > {GAP_MS}, false) AS ga
  FROM {source} WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal)),
b AS (SELECT *, max(CASE WHEN gb THEN t END) OVER (PARTITION BY vehicle_id ORDER BY t, ordinal ROWS UNBOUNDED PRECEDING) AS ge,
  min(CASE WHEN ga THEN t END) OVER (PARTITION BY vehicle_id ORDER BY t, ordinal ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS gs,
  t0 + CAST(ceil((t - t0) / {STEP_MS}.0::DOUBLE) AS BIGINT) * {STEP_MS} AS lo, CASE WHEN u IS NULL OR ga THEN t ELSE u - 1 END AS hi FROM a),
c AS (SELECT *, unnest(generate_series(lo, hi, {STEP_MS})) AS g FROM b WHERE lo <= hi),
grid AS (SELECT vehicle_id, g AS timestamp_ms, {", ".join(value(v) for v in trajectory.VALUES)}, coalesce(g <= ge + {STEP_MS}, false) OR coalesce(g >= gs - {STEP_MS}, false) AS gap_flag FROM c)"""


@query(_resample_sql("pos") + " SELECT vehicle_id, timestamp_ms, " + ", ".join(rnd(v) for v in trajectory.VALUES) + ", gap_flag FROM grid")
def resample_grid(spark, d):
    return rounded(trajectory.resample(positions(spark, d), step_ms=STEP_MS, gap_ms=GAP_MS))


_SAMPLES = _SMOOTH + _resample_sql("sm")


@query(
    _SAMPLES
    + f""" SELECT vehicle_id, timestamp_ms, {rnd('latitude', 'lat_deg')}, {rnd('longitude', 'lon_deg')}, {rnd('altitude', 'alt_m')}, {rnd('speed_mps')}, {rnd('heading_deg')},
  gap_flag AS quality_gap, false AS quality_extrapolated, coalesce(speed_mps < 1.0, false) AS quality_low_speed FROM grid"""
)
def trajectory_samples(spark, d):
    from ..sources.tables import flat_samples

    found = trajectory.trajectory_samples(positions(spark, d), step_ms=STEP_MS, gap_ms=GAP_MS)
    return rounded(flat_samples(found).drop("x_m", "y_m"))


@query(_SAMPLES + " SELECT CASE WHEN gap_flag THEN 'gap' WHEN coalesce(speed_mps < 1.0, false) THEN 'low_speed' ELSE 'normal' END AS class, count(*) AS samples FROM grid GROUP BY 1")
def quality_flag_counts(spark, d):
    found = trajectory.trajectory_samples(positions(spark, d), step_ms=STEP_MS, gap_ms=GAP_MS)
    return found.groupBy(trajectory.map_class().alias("class")).agg(F.count(F.lit(1)).alias("samples"))


@query("SELECT ordinal, vehicle_id, round((timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal)) / 1000.0::DOUBLE, 6) AS delta_s FROM pos")
def vehicle_time_deltas(spark, d):
    return rounded(trajectory.time_deltas(positions(spark, d)).select("ordinal", "vehicle_id", "delta_s"))


# --- coordinates ----------------------------------------------------------

_FIRST = ", o AS (SELECT latitude AS lat0, longitude AS lon0, altitude AS alt0 FROM pos ORDER BY vehicle_id, timestamp_ms, ordinal LIMIT 1)"
_ORDER = ("vehicle_id", "timestamp_ms", "ordinal")
_E2 = f"{geo.E2!r}::DOUBLE"


def _ecef_sql(lat: str, lon: str, alt: str, n: str) -> str:
    r = f"({geo.A!r}::DOUBLE / sqrt(1 - {_E2} * pow(sin(radians({lat})), 2)))"
    return f"({r} + {alt}) * cos(radians({lat})) * cos(radians({lon})) AS x{n}, ({r} + {alt}) * cos(radians({lat})) * sin(radians({lon})) AS y{n}, ({r} * {1 - geo.E2!r}::DOUBLE + {alt}) * sin(radians({lat})) AS z{n}"


@query(
    _FIRST
    + f""", t AS (SELECT ordinal, lat0, lon0, {_ecef_sql("latitude", "longitude", "altitude", "1")}, {_ecef_sql("lat0", "lon0", "alt0", "0")} FROM pos, o),
u AS (SELECT ordinal, radians(lat0) AS p, radians(lon0) AS q, x1 - x0 AS dx, y1 - y0 AS dy, z1 - z0 AS dz FROM t)
SELECT ordinal, round(cos(q) * dy - sin(q) * dx, 4) + 0.0 AS x_m, round(cos(p) * dz - sin(p) * (cos(q) * dx + sin(q) * dy), 4) + 0.0 AS y_m FROM u"""
)
def enu_project(spark, d):
    found, _ = coordinates.project(samples(spark, d), order=_ORDER)
    return rounded(found.select("ordinal", "x_m", "y_m"), 4)


def _utm_sql(lat: str, lon: str, zone: str) -> str:
    """East and north of the northern half, as SQL text."""
    e, k = f"{geo.E2 ** 0.5!r}::DOUBLE", f"{geo.K0 * geo.RADIUS!r}::DOUBLE"
    atanh = lambda x: f"(0.5::DOUBLE * ln((1 + {x}) / (1 - {x})))"
    sinh, cosh = (lambda x: f"((exp({x}) - exp(-({x}))) / 2)"), (lambda x: f"((exp({x}) + exp(-({x}))) / 2)")
    s, dl = f"sin(radians({lat}))", f"radians({lon} - ({zone} * 6 - 183))"
    t = sinh(f"{atanh(s)} - {e} * {atanh(f'({e} * {s})')}")
    out = f"SELECT ordinal, atan2(t, cos(d)) AS xi, ln(sin(d) / sqrt(t * t + pow(cos(d), 2)) + sqrt(pow(sin(d), 2) / (t * t + pow(cos(d), 2)) + 1)) AS eta FROM (SELECT ordinal, {t} AS t, {dl} AS d FROM src)"
    east = " + ".join(["eta", *[f"{a!r}::DOUBLE * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, a in enumerate(geo.ALPHA, 1)]])
    north = " + ".join(["xi", *[f"{a!r}::DOUBLE * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, a in enumerate(geo.ALPHA, 1)]])
    return f"SELECT ordinal, 500000.0::DOUBLE + {k} * ({east}) AS x_m, {k} * ({north}) AS y_m FROM ({out})"


@query(
    _FIRST
    + f", src AS (SELECT ordinal, latitude, longitude, CAST(floor((lon0 + 180) / 6) AS INTEGER) + 1 AS zone FROM pos, o), f AS ({_utm_sql('latitude', 'longitude', 'zone')})"
    + " SELECT ordinal, round(x_m, 4) AS x_m, round(y_m, 4) AS y_m FROM f"
)
def utm_project(spark, d):
    return rounded(coordinates.to_utm(samples(spark, d), order=_ORDER).select("ordinal", "x_m", "y_m"), 4)


@query(
    ", src AS (SELECT ordinal, latitude, longitude, 32 AS zone FROM pos UNION ALL SELECT -1, 50.5::DOUBLE, 6.5::DOUBLE, 32)"
    + f", f AS ({_utm_sql('latitude', 'longitude', 'zone')}) SELECT f.ordinal, round(f.x_m - o.x_m, 3) + 0.0 AS x_m, round(f.y_m - o.y_m, 3) + 0.0 AS y_m FROM f, f o WHERE o.ordinal = -1 AND f.ordinal >= 0"
)
def utm_relative(spark, d):
    return rounded(coordinates.to_utm(samples(spark, d), 50.5, 6.5).select("ordinal", "x_m", "y_m"), 3)


@query("SELECT ordinal, round(latitude, 8) AS latitude, round(longitude, 8) AS longitude FROM pos")
def utm_round_trip(spark, d):
    p, south = positions(spark, d), F.lit(False)
    zone = geo.utm_zone(F.col("longitude"))
    east, north = geo.utm_forward(F.col("latitude"), F.col("longitude"), zone, south)
    q = p.select("ordinal", east.alias("x"), north.alias("y"), zone.alias("zone"))
    lat, lon = geo.utm_inverse(F.col("x"), F.col("y"), F.col("zone"), south)
    return rounded(q.select("ordinal", lat.alias("latitude"), lon.alias("longitude")), 8)


@query("SELECT ordinal, least(CAST(floor((longitude + 180) / 6) AS INTEGER) + 1, 60) AS zone FROM pos")
def utm_zones(spark, d):
    return positions(spark, d).select("ordinal", geo.utm_zone(F.col("longitude")).alias("zone"))


def _origin_queries() -> None:
    sql = {
        "first": _FIRST + " SELECT round(lat0, 6) AS lat, round(lon0, 6) AS lon, round(alt0, 6) AS alt FROM o",
        "centroid": "SELECT round(avg(latitude), 6) AS lat, round(avg(longitude), 6) AS lon, round(avg(altitude), 6) AS alt FROM pos",
        "median": "SELECT round(median(latitude), 6) AS lat, round(median(longitude), 6) AS lon, round(median(altitude), 6) AS alt FROM pos",
    }
    for method, text in sql.items():

        def origin(spark, d, method=method):
            return rounded(coordinates.origin_table(samples(spark, d), method, order=_ORDER) if method == "first" else coordinates.origin_table(samples(spark, d), method))

        origin.__name__ = f"origin_{method}"
        query(text)(origin)


_origin_queries()


@query(
    """, l AS (SELECT ordinal, vehicle_id, latitude AS b, longitude AS e, lag(latitude) OVER w AS a, lag(longitude) OVER w AS c FROM pos WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp_ms, ordinal))
SELECT ordinal, vehicle_id, round(2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * pow(sin(radians(e - c) / 2), 2)))), 4) AS step_m FROM l"""
)
def haversine_steps(spark, d):
    w = trajectory.by_time()
    lat, lon = F.col("latitude"), F.col("longitude")
    step = geo.haversine_m(F.lag(lat).over(w), F.lag(lon).over(w), lat, lon)
    return rounded(positions(spark, d).select("ordinal", "vehicle_id", step.alias("step_m")), 4)


@query(
    """SELECT vehicle_id, CAST(sum(messages_sent) AS BIGINT) AS messages_sum, round(avg(messages_sent), 6) AS messages_mean, round(stddev_samp(messages_sent), 6) AS messages_std,
  CAST(sum(total_bytes_sent) AS BIGINT) AS bytes_sum, round(min(latitude), 6) AS min_latitude, round(max(latitude), 6) AS max_latitude, round(min(longitude), 6) AS min_longitude, round(max(longitude), 6) AS max_longitude,
  round(max(latitude) - min(latitude), 6) AS lat_range, round(max(longitude) - min(longitude), 6) AS lon_range,
  round(sqrt(pow(max(latitude) - min(latitude), 2) + pow(max(longitude) - min(longitude), 2)), 6) AS mobility_range FROM fused GROUP BY 1"""
)
def vehicle_behaviour(spark, d):
    return rounded(an.vehicle_behaviour(fused(spark, d)))


@query("SELECT vehicle_id, round(sqrt(pow(max(latitude) - min(latitude), 2) + pow(max(longitude) - min(longitude), 2)), 6) AS mobility_range FROM pos GROUP BY 1")
def mobility_range(spark, d):
    lat, lon = (F.max(c) - F.min(c) for c in ("latitude", "longitude"))
    return rounded(positions(spark, d).groupBy("vehicle_id").agg(F.hypot(lat, lon).alias("mobility_range")))


# --- analytics ------------------------------------------------------------

_CELLS = """, cells AS (SELECT CAST(trunc(latitude / 0.05::DOUBLE) AS BIGINT) AS lat_cell, CAST(trunc(longitude / 0.05::DOUBLE) AS BIGINT) AS lon_cell,
  CAST(sum(messages_sent) AS BIGINT) AS total_messages, CAST(sum(total_bytes_sent) AS BIGINT) AS total_bytes, count(*) AS points, count(DISTINCT vehicle_id) AS vehicles FROM fused GROUP BY 1, 2)"""


@query(_CELLS + " SELECT * FROM cells")
def grid_density(spark, d):
    return an.grid_stats(fused(spark, d), size=0.05)


@query(_CELLS + " SELECT * FROM cells ORDER BY total_messages DESC, lat_cell, lon_cell LIMIT 10")
def grid_density_topk(spark, d):
    return an.top_k(an.grid_stats(fused(spark, d), size=0.05), "total_messages", 10, ("lat_cell", "lon_cell"))


@query(_CELLS + " SELECT * FROM cells WHERE total_messages > 0")
def grid_hotspots_active(spark, d):
    return an.grid_stats(fused(spark, d), size=0.05, active=True)


_HEAT = """, e AS (SELECT min(latitude) AS a0, max(latitude) AS a1, min(longitude) AS b0, max(longitude) AS b1 FROM fused),
h AS (SELECT CAST(floor((latitude - a0) * 49 / (a1 - a0)) AS BIGINT) AS lat_bin, CAST(floor((longitude - b0) * 49 / (b1 - b0)) AS BIGINT) AS lon_bin, avg_latency_ms, total_bytes_sent
  FROM fused, e WHERE latitude < a1 AND longitude < b1)"""


@query(_HEAT + " SELECT lat_bin, lon_bin, round(avg(avg_latency_ms), 6) AS value, count(*) AS rows FROM h WHERE avg_latency_ms IS NOT NULL GROUP BY 1, 2")
def latency_heatmap(spark, d):
    return rounded(an.heatmap(fused(spark, d), F.col("avg_latency_ms"), "mean", over=positions(spark, d)))


@query(_HEAT + " SELECT lat_bin, lon_bin, CAST(sum(total_bytes_sent) AS BIGINT) AS value, count(*) AS rows FROM h GROUP BY 1, 2")
def throughput_heatmap(spark, d):
    return an.heatmap(fused(spark, d), F.col("total_bytes_sent"), "sum", over=positions(spark, d))


_WAYS = "CASE WHEN direction = 'uplink_to_rsu' THEN message_size_bytes ELSE 0 END AS tx_bytes, CASE WHEN direction = 'downlink_from_rsu' THEN message_size_bytes ELSE 0 END AS rx_bytes"


def _ways(spark, d):
    size, way = F.col("message_size_bytes"), F.col("direction")
    return messages(spark, d).withColumn("tx_bytes", F.when(way == "uplink_to_rsu", size).otherwise(0)).withColumn("rx_bytes", F.when(way == "downlink_from_rsu", size).otherwise(0))


@query(f"SELECT timestamp_ms // {STEP_MS} AS step, CAST(sum(tx_bytes) AS BIGINT) AS tx_bytes, CAST(sum(rx_bytes) AS BIGINT) AS rx_bytes FROM (SELECT timestamp_ms, {_WAYS} FROM msg) GROUP BY 1")
def throughput_series(spark, d):
    return an.throughput_series(_ways(spark, d), step_ms=STEP_MS)


@query(f"SELECT timestamp_ms // {STEP_MS} AS step, CAST(sum(tx_bytes) AS BIGINT) AS tx_bytes, CAST(sum(rx_bytes) AS BIGINT) AS rx_bytes FROM (SELECT timestamp_ms, {_WAYS} FROM msg WHERE vehicle_id = '7') GROUP BY 1")
def vehicle_throughput_series(spark, d):
    return an.throughput_series(_ways(spark, d), step_ms=STEP_MS, vehicle="7")


@query("SELECT timestamp_ms, latency_ms FROM msg WHERE vehicle_id = '7'")
def vehicle_latency_series(spark, d):
    return an.vehicle_series(messages(spark, d), "7", ["latency_ms"])


@query("SELECT count(*) AS points, count(DISTINCT vehicle_id) AS vehicles, round((max(timestamp_ms) - min(timestamp_ms)) / 60000.0::DOUBLE, 6) AS span_min FROM pos")
def trajectory_totals(spark, d):
    return rounded(an.trajectory_totals(positions(spark, d)))


@query("SELECT " + ", ".join(f"{f}({c}) AS {f}_{c}" for c in ("latitude", "longitude", "altitude") for f in ("min", "max")) + " FROM pos")
def geo_extent(spark, d):
    return an.geo_extent(positions(spark, d))


@query("SELECT message_type, count(*) AS count FROM msg GROUP BY 1")
def message_type_counts(spark, d):
    return an.value_counts(messages(spark, d))


_SIZE = "message_size_bytes"


@query(f"SELECT message_type, count(*) AS messages, round(avg({_SIZE}), 6) AS mean_bytes, round(stddev_samp({_SIZE}), 6) AS std_bytes, min({_SIZE}) AS min_bytes, max({_SIZE}) AS max_bytes, CAST(sum({_SIZE}) AS BIGINT) AS sum_bytes FROM msg GROUP BY 1")
def message_type_stats(spark, d):
    return rounded(an.message_type_stats(messages(spark, d)))


@query(f"SELECT CAST(sum({_SIZE}) AS BIGINT) AS total_bytes, round(sum({_SIZE}) / 1048576.0::DOUBLE, 6) AS total_mb, round(avg({_SIZE}), 6) AS mean_bytes, min({_SIZE}) AS min_bytes, max({_SIZE}) AS max_bytes FROM msg")
def message_size_stats(spark, d):
    return rounded(an.message_sizes(messages(spark, d)))


def _describe_sql(source: str, column: str) -> str:
    q = ", ".join(f"round(quantile_cont({column}, {p}), 6) AS {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return f"SELECT count({column}) AS count, round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std, round(CAST(min({column}) AS DOUBLE), 6) AS min, {q}, round(CAST(max({column}) AS DOUBLE), 6) AS max FROM {source}"


@query(_describe_sql("(SELECT CAST(count(*) AS DOUBLE) AS n FROM msg GROUP BY vehicle_id)", "n"))
def messages_per_vehicle_describe(spark, d):
    return rounded(an.describe(an.per_vehicle(messages(spark, d)), "n"))


@query(_describe_sql("(SELECT CAST(count(*) AS DOUBLE) AS n FROM pos GROUP BY vehicle_id)", "n"))
def points_per_vehicle_describe(spark, d):
    return rounded(an.describe(an.per_vehicle(positions(spark, d)), "n"))


@query("SELECT round(avg(n), 6) AS mean, round(median(n), 6) AS median, max(n) AS max FROM (SELECT count(*) AS n FROM msg GROUP BY vehicle_id)")
def messages_per_vehicle(spark, d):
    return rounded(an.per_vehicle_summary(messages(spark, d)))


@query(
    """SELECT count(*) AS points, count(*) FILTER (messages_sent > 0) AS active_points, round(count(*) FILTER (messages_sent > 0) * 100.0::DOUBLE / count(*), 6) AS active_pct,
  CAST(sum(messages_sent) AS BIGINT) AS messages, CAST(sum(total_bytes_sent) AS BIGINT) AS bytes, round(avg(messages_sent) FILTER (messages_sent > 0), 6) AS mean_messages_active,
  round(avg(total_bytes_sent) FILTER (messages_sent > 0), 6) AS mean_bytes_active FROM fused"""
)
def active_share(spark, d):
    return rounded(an.active_share(fused(spark, d)))


_HOUR = "CAST((timestamp_ms % 86400000) // 3600000 AS INTEGER) AS hour"


@query(f"SELECT {_HOUR}, count(*) AS messages, CAST(sum({_SIZE}) AS BIGINT) AS bytes, round(avg({_SIZE}), 6) AS mean_bytes FROM msg GROUP BY 1")
def hourly_pattern(spark, d):
    return rounded(an.hourly_messages(messages(spark, d)))


@query(f"SELECT {_HOUR}, CAST(sum(messages_sent) AS BIGINT) AS messages_sent FROM fused GROUP BY 1")
def hourly_sent(spark, d):
    return an.hourly_sent(fused(spark, d))


_DATE = "strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS date"


@query(f"SELECT {_DATE}, count(*) AS messages, CAST(sum({_SIZE}) AS BIGINT) AS bytes FROM msg GROUP BY 1 ORDER BY 1 LIMIT 10")
def daily_volume(spark, d):
    return an.daily_volume(messages(spark, d), 10)


@query(f"SELECT {_DATE}, message_type, count(*) AS messages FROM msg GROUP BY 1, 2")
def date_type_counts(spark, d):
    return an.date_type_counts(messages(spark, d))


_VALID = f""", v AS (SELECT vehicle_id, count(*) AS msg_count, CAST(sum({_SIZE}) AS BIGINT) AS total_bytes, round(avg({_SIZE}), 6) AS mean_bytes, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms,
  round((max(timestamp_ms) - min(timestamp_ms)) / 3600000.0::DOUBLE, 6) AS duration_hours FROM msg WHERE vehicle_id <> 'unknown' GROUP BY 1)"""


@query(_VALID + " SELECT * FROM v")
def valid_vehicle_stats(spark, d):
    return rounded(an.valid_vehicle_stats(messages(spark, d)))


@query(_VALID + " SELECT * FROM v ORDER BY msg_count DESC, vehicle_id LIMIT 10")
def top_active_vehicles(spark, d):
    return rounded(an.top_k(an.valid_vehicle_stats(messages(spark, d)), "msg_count", 10, ("vehicle_id",)))


@query("SELECT vehicle_id, count(*) AS points, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms, round((max(timestamp_ms) - min(timestamp_ms)) / 1000.0::DOUBLE, 6) AS span_s FROM pos GROUP BY 1")
def vehicle_spans(spark, d):
    return rounded(an.vehicle_spans(positions(spark, d)))


@query(f"SELECT sender_id, receiver_id, count(*) AS messages, CAST(sum({_SIZE}) AS BIGINT) AS bytes, round(avg(latency_ms), 6) AS mean_latency_ms FROM msg WHERE receiver_id IS NOT NULL GROUP BY 1, 2")
def link_stats(spark, d):
    return rounded(an.link_stats(messages(spark, d)))


@query("SELECT round(corr(speed_mps, messages_sent), 6) AS corr, count(speed_mps) AS n FROM fused")
def speed_comm_corr(spark, d):
    return rounded(an.speed_correlation(fused(spark, d)))


@query("SELECT CAST(floor(speed_mps / 5.0::DOUBLE) AS BIGINT) AS bucket, count(*) AS points, CAST(sum(messages_sent) AS BIGINT) AS messages, round(avg(messages_sent), 6) AS mean_messages FROM fused GROUP BY 1")
def speed_buckets(spark, d):
    return rounded(an.speed_buckets(fused(spark, d)))


_PROFILED = ("timestamp_ms", "vehicle_id", "receiver_id", "latency_ms")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM msg" for c in _PROFILED))
def null_profile(spark, d):
    return an.null_profile(messages(spark, d).select(*_PROFILED))


@query(_describe_sql("(SELECT (timestamp_ms - lag(timestamp_ms) OVER (ORDER BY timestamp_ms, ordinal)) / 1000.0::DOUBLE AS x FROM pos)", "x"))
def time_delta_describe(spark, d):
    return rounded(an.delta_stats(positions(spark, d)))


@query(
    f"""SELECT p.n AS trajectory_points, p.v AS unique_vehicles, m.n AS v2x_messages, m.b AS total_bytes_sent, m.a AS avg_message_size, f.n AS fused_points
FROM (SELECT count(*) AS n, count(DISTINCT vehicle_id) AS v FROM pos) p, (SELECT count(*) AS n, CAST(coalesce(sum({_SIZE}), 0) AS BIGINT) AS b, round(coalesce(avg({_SIZE}), 0), 6) AS a FROM msg) m, (SELECT count(*) AS n FROM fused) f"""
)
def run_stats(spark, d):
    return rounded(an.run_stats(positions(spark, d), messages(spark, d), fused(spark, d)))


@query("SELECT count(*) AS messages, count(*) FILTER (vehicle_id <> 'unknown') AS with_id, round(count(*) FILTER (vehicle_id <> 'unknown') * 100.0::DOUBLE / count(*), 6) AS with_id_pct, count(DISTINCT nullif(vehicle_id, 'unknown')) AS ids FROM msg")
def id_share(spark, d):
    return rounded(an.id_share(messages(spark, d)))


@query("SELECT ordinal, timestamp_ms, vehicle_id FROM pos ORDER BY timestamp_ms, ordinal LIMIT 20")
def first_positions(spark, d):
    return an.head(positions(spark, d).select("ordinal", "timestamp_ms", "vehicle_id"), 20, ("timestamp_ms", "ordinal"))


@query("SELECT vehicle_id, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms, round((max(timestamp_ms) - min(timestamp_ms)) / 60000.0::DOUBLE, 6) AS duration_min FROM fused WHERE messages_sent > 0 GROUP BY 1")
def active_vehicle_seen(spark, d):
    found = an.vehicle_rates(filters.active_only(fused(spark, d)))
    return rounded(found.select("vehicle_id", "first_ms", "last_ms", "duration_min"))


# --- ids, records, profiling ----------------------------------------------


@query(
    """, c AS (SELECT CAST(ordinal % 97 AS VARCHAR) AS file, CASE WHEN ordinal % 97 < 40 THEN 'a' ELSE vehicle_id END AS vehicle_id FROM msg),
n AS (SELECT file, vehicle_id, count(*) AS k FROM c GROUP BY 1, 2), s AS (SELECT file, arg_max(vehicle_id, k) AS id, max(k) / CAST(sum(k) AS DOUBLE) AS share FROM n GROUP BY 1)
SELECT file, CASE WHEN share > 0.8 THEN id ELSE 'unknown' END AS vehicle_id FROM s"""
)
def infer_vehicle_id(spark, d):
    file = (F.col("ordinal") % 97).cast("string")
    ids = messages(spark, d).select(file.alias("file"), F.when(F.col("ordinal") % 97 < 40, "a").otherwise(F.col("vehicle_id")).alias("vehicle_id"))
    return an.majority_ids(ids)


@query(
    """, t AS (SELECT ordinal, CASE ordinal % 3 WHEN 0 THEN timestamp_ms // 1000 WHEN 1 THEN timestamp_ms ELSE timestamp_ms * 1000 + 7 END AS raw FROM pos)
SELECT ordinal, CASE WHEN raw < 10000000000 THEN 's' WHEN raw < 10000000000000 THEN 'ms' ELSE 'us' END AS unit,
  CASE WHEN raw < 10000000000 THEN raw * 1000 WHEN raw < 10000000000000 THEN raw ELSE raw // 1000 END AS ms FROM t"""
)
def normalize_timestamps(spark, d):
    ms, pick = F.col("timestamp_ms"), F.col("ordinal") % 3
    raw = F.when(pick == 0, scalars.floor_div(ms, 1000)).when(pick == 1, ms).otherwise(ms * 1000 + 7)
    found = positions(spark, d).select("ordinal", raw.alias("raw"))
    return found.select("ordinal", scalars.timestamp_unit(F.col("raw")).alias("unit"), scalars.to_millis(F.col("raw")).alias("ms"))


def _objects(spark: SparkSession, d: str) -> DataFrame:
    """Flat records under varying names, made of the events."""
    i, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    member = lambda name, value: F.concat(F.lit(f'"{name}":'), value.cast("string"))
    parts = [
        F.when(i % 2 == 0, member("stationID", quote(F.col("user_id").cast("string")))).when(i % 9 != 0, member("vehicle_id", F.col("user_id"))),
        F.when(i % 4 == 0, member("timestamp", scalars.floor_div(ms, 1000))).otherwise(F.concat(F.lit('"timestamp":0,'), member("timestamp_utc_ms", ms))),
        F.when(i % 3 == 0, F.concat_ws(",", member("lat", F.lit(50) + k), member("longitude", F.lit(6)))),
        F.when(i % 3 == 1, F.concat_ws(",", member("messageType", quote(F.col("event_type"))), member("tx_timestamp", ms), member("rx_timestamp", ms + k), member("direction", F.when(i % 2 == 0, F.lit('"v2v"')).otherwise(F.lit('"sideways"'))), member("payload_bytes", k))),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return table(spark, d, "events").select(F.lit("events").alias("file"), i.alias("ordinal"), F.parse_json(text).alias("record"))


_RAW = """WITH r AS (SELECT event_id AS ordinal, event_type, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms,
  CASE WHEN event_id % 2 = 0 OR event_id % 9 <> 0 THEN CAST(user_id AS VARCHAR) END AS vehicle_id, CASE WHEN event_id % 4 = 0 THEN (epoch_us(ts) // 1000000) * 1000 ELSE epoch_us(ts) // 1000 END AS t FROM events)"""


@query(_RAW + " SELECT ordinal, vehicle_id, CAST(t AS BIGINT) AS timestamp_utc_ms, CAST(50 + k AS DOUBLE) AS latitude_deg, 6.0::DOUBLE AS longitude_deg, CASE WHEN ordinal % 2 = 0 THEN vehicle_id END AS station_id FROM r WHERE ordinal % 3 = 0 AND vehicle_id IS NOT NULL")
def parse_gnss(spark, d):
    from ..operators.records import parse_gnss as parse

    return parse(_objects(spark, d)).select("ordinal", "vehicle_id", "timestamp_utc_ms", "latitude_deg", "longitude_deg", "station_id")


@query(
    _RAW
    + """ SELECT ordinal, vehicle_id, CAST(t AS BIGINT) AS timestamp_utc_ms, CASE WHEN m THEN ms ELSE -1 END AS tx_timestamp_utc_ms, CASE WHEN m THEN ms + k ELSE -1 END AS rx_timestamp_utc_ms,
  CASE WHEN m THEN event_type END AS message_type, CASE WHEN m AND ordinal % 2 = 0 THEN 'v2v' END AS direction, CASE WHEN m THEN k ELSE -1 END AS payload_bytes, CASE WHEN m THEN CAST(k AS DOUBLE) END AS latency_ms
FROM (SELECT *, ordinal % 3 = 1 AS m FROM r) WHERE vehicle_id IS NOT NULL"""
)
def parse_v2x(spark, d):
    from ..operators.records import parse_messages as parse

    return parse(_objects(spark, d)).select("ordinal", "vehicle_id", "timestamp_utc_ms", filled("tx_timestamp_utc_ms"), filled("rx_timestamp_utc_ms"), "message_type", "direction", filled("payload_bytes"), "latency_ms")


@query(
    _RAW
    + """ SELECT CAST(1 AS BIGINT) AS total_files, count(*) FILTER (ordinal % 3 = 0) AS gnss_records, count(*) FILTER (ordinal % 3 = 1) AS v2x_records, count(*) FILTER (ordinal % 3 = 2) AS other_records,
  count(DISTINCT CASE WHEN ordinal % 2 = 0 OR vehicle_id <> '0' THEN vehicle_id END) AS vehicle_count, string_agg(DISTINCT CASE WHEN ordinal % 3 = 1 THEN event_type END, ',' ORDER BY CASE WHEN ordinal % 3 = 1 THEN event_type END) AS message_types FROM r"""
)
def discovery_summary(spark, d):
    from ..operators.records import discovery_summary as summary

    found = summary(_objects(spark, d), 1)
    return found.select("total_files", "gnss_records", "v2x_records", "other_records", "vehicle_count", F.array_join("message_types", ",").alias("message_types"))


@query("SELECT m.ordinal, coalesce('v' || CASE WHEN CAST(m.vehicle_id AS VARCHAR) IN ('1', '2', '3') THEN m.vehicle_id END, m.vehicle_id) AS vehicle_id FROM msg m")
def identity_map_join(spark, d):
    return side_files.apply_identity_map(messages(spark, d), {"1": "v1", "2": "v2", "3": "v3"}).select("ordinal", "vehicle_id")


@query("SELECT m.ordinal, m.receiver_id AS rsu_id, r.lat AS rsu_lat, r.lon AS rsu_lon FROM msg m LEFT JOIN (VALUES ('1', 50.5::DOUBLE, 6.5::DOUBLE), ('2', NULL, NULL)) r(id, lat, lon) ON r.id = m.receiver_id")
def rsu_join(spark, d):
    rsus = {"1": {"location": {"lat": 50.5, "lon": 6.5}}, "2": {"name": "nowhere"}}
    return side_files.with_rsus(messages(spark, d).withColumnRenamed("receiver_id", "rsu_id"), rsus).select("ordinal", "rsu_id", "rsu_lat", "rsu_lon")


@query(_poly(RING) + _KEEP["first"].format(t="pi", i="i"))
def polygon_file(spark, d):
    """A region from a GeoJSON file, here the first feature of a collection, of whose polygon holes are ignored."""
    import json
    import os
    import tempfile

    hole = [[6.4, 50.3], [6.5, 50.3], [6.5, 50.4], [6.4, 50.3]]
    shape = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [RING, hole]}}]}
    with tempfile.NamedTemporaryFile("w", suffix=".geojson", delete=False) as out:  # the driver alone reads it
        json.dump(shape, out)
    found = filters.filter_polygon_file(positions(spark, d), out.name, "first")
    os.unlink(out.name)
    return found.select("ordinal", "vehicle_id")


@query(_poly(RING) + _KEEP["intersect"].format(t="pi", i="i"))
def polygon_geometry(spark, d):
    ring = side_files.geojson_ring({"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[RING], [NOTCHED]]}})
    return filters.filter_polygon(positions(spark, d), ring).select("ordinal", "vehicle_id")


# Aliases: every name of a field in turn.


def _aliased(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    member = lambda name, value: F.concat(F.lit('"'), name, F.lit('":'), value.cast("string"))
    turn = lambda names: F.element_at(F.array(*map(F.lit, names)), (i % len(names) + 1).cast("int"))
    quote = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    parts = [
        member(turn(scalars.VEHICLE_ID), quote(F.col("user_id"))),
        member(F.lit("timestamp"), ms),
        member(turn(scalars.LATITUDE), F.lit(50) + k / F.lit(128.0)),
        member(turn(scalars.LONGITUDE), F.lit(6.5)),
        F.when(k > 10, member(turn(scalars.ALTITUDE), k)),
        F.when(k > 20, member(turn(scalars.SPEED), k / F.lit(4.0))),
        member(turn(scalars.HEADING), i % 360),
        F.when(k > 30, member(turn(scalars.STATION_TYPE), quote(i % 5))),
        F.when(k > 40, member(turn(scalars.RSU_ID), quote(F.concat(F.lit("R"), i % 7)))),
        member(turn(scalars.MESSAGE_TYPE), quote(F.col("event_type"))),
        F.when(k > 50, member(F.lit("frame_bytes"), k + 100)),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return table(spark, d, "events").select(F.lit("events").alias("file"), i.alias("ordinal"), F.parse_json(text).alias("record"))


_ALIASED = "WITH r AS (SELECT event_id AS ordinal, event_type, CAST(user_id AS VARCHAR) AS vehicle_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_utc_ms FROM events)"


@query(
    _ALIASED
    + """ SELECT ordinal, vehicle_id, timestamp_utc_ms, 50 + k / 128.0::DOUBLE AS latitude_deg, 6.5::DOUBLE AS longitude_deg, CASE WHEN k > 10 THEN CAST(k AS DOUBLE) END AS altitude_m,
  CASE WHEN k > 20 THEN k / 4.0::DOUBLE END AS speed_mps, CAST(ordinal % 360 AS DOUBLE) AS heading_deg, CASE WHEN k > 30 THEN CAST(ordinal % 5 AS VARCHAR) END AS station_type FROM r"""
)
def parse_gnss_aliases(spark, d):
    from ..operators.records import parse_gnss as parse

    return parse(_aliased(spark, d)).select("ordinal", "vehicle_id", "timestamp_utc_ms", "latitude_deg", "longitude_deg", "altitude_m", "speed_mps", "heading_deg", "station_type")


@query(
    _ALIASED
    + """ SELECT ordinal, vehicle_id, timestamp_utc_ms, CASE WHEN k > 30 THEN CAST(ordinal % 5 AS VARCHAR) END AS station_type, CASE WHEN k > 40 THEN 'R' || CAST(ordinal % 7 AS VARCHAR) END AS rsu_id,
  event_type AS message_type, CASE WHEN k > 50 THEN k + 100 ELSE -1 END AS frame_bytes FROM r"""
)
def parse_v2x_aliases(spark, d):
    from ..operators.records import parse_messages as parse

    return parse(_aliased(spark, d)).select("ordinal", "vehicle_id", "timestamp_utc_ms", "station_type", "rsu_id", "message_type", filled("frame_bytes"))


@query(_ALIASED + " SELECT DISTINCT vehicle_id FROM r WHERE vehicle_id <> ''")
def discovered_vehicles(spark, d):
    from ..operators.records import discovered_vehicles as found

    return found(_aliased(spark, d))


@query(
    _RAW
    + """, c AS (SELECT count(*) FILTER (ordinal % 3 = 0) AS g, count(*) FILTER (ordinal % 3 = 1) AS v, count(*) FILTER (ordinal % 3 = 2) AS o,
  count(DISTINCT CASE WHEN ordinal % 2 = 0 OR vehicle_id <> '0' THEN vehicle_id END) AS n, string_agg(DISTINCT CASE WHEN ordinal % 3 = 1 THEN event_type END, ', ' ORDER BY CASE WHEN ordinal % 3 = 1 THEN event_type END) AS t FROM r)
SELECT unnest(['Total files', 'GNSS records', 'V2X records', 'Other records', 'Unique vehicles', 'Message types', 'Sample limit']) AS metric,
  unnest(['1', CAST(g AS VARCHAR), CAST(v AS VARCHAR), CAST(o AS VARCHAR), CAST(n AS VARCHAR), t, 'none']) AS value FROM c"""
)
def discovery_table(spark, d):
    from ..operators import records

    return records.discovery_table(records.discovery_summary(_objects(spark, d), 1))


# --- reading JSON -----------------------------------------------------------


def _shaped(spark: SparkSession, d: str) -> DataFrame:
    """Texts of files, one per user: by the user's number an array, JSON Lines, one object, or no JSON."""
    u, i = F.col("user_id"), F.col("event_id")
    record = F.concat(F.lit('{"stationID": "'), u.cast("string"), F.lit('", "n": '), i.cast("string"), F.lit("}"))
    rows = table(spark, d, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", record.alias("r")))), lambda x: x["r"]).alias("r"))
    first, rest = F.element_at("r", 1), F.slice("r", 2, 1 << 30)
    array = F.concat(F.lit("[5, "), F.array_join("r", ",\n "), F.lit("]"))
    lines = F.concat(first, F.lit("\n\n"), F.array_join(rest, "\n"), F.lit('\n{"broken'))
    alone = F.replace(first, F.lit(", "), F.lit(",\n"))
    value = F.when(u % 4 == 0, array).when(u % 4 == 1, lines).when(u % 4 == 2, alone).otherwise("no JSON at all")
    return rows.select(F.concat(F.lit("f"), u).alias("file"), value.alias("value"))


_READ = """WITH e AS (SELECT user_id AS u, event_id AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
o AS (SELECT 'f' || CAST(u AS VARCHAR) AS file, u % 4 AS shape, CASE u % 4 WHEN 0 THEN rn WHEN 1 THEN CASE WHEN rn = 1 THEN 0 ELSE rn END ELSE 0 END AS ordinal, CAST(u AS VARCHAR) AS id, n, rn FROM e WHERE u % 4 < 2 OR (u % 4 = 2 AND rn = 1))"""


def _read(spark, d, **how):
    from ..sources import json_records

    found = json_records.read_objects(_shaped(spark, d), **how)
    return found.select("file", "ordinal", scalars.get("record", "stationID").alias("id"), scalars.get("record", "n", "bigint").alias("n"))


@query(_READ + " SELECT file, CAST(ordinal AS BIGINT) AS ordinal, id, n FROM o")
def read_shapes(spark, d):
    return _read(spark, d)


@query(_READ + " SELECT file, CAST(ordinal AS BIGINT) AS ordinal, id, n FROM o WHERE rn <= 3")
def read_sampled(spark, d):
    return _read(spark, d, sample=3)


@query("SELECT DISTINCT 'f' || CAST(user_id AS VARCHAR) AS file FROM events WHERE user_id % 4 = 3")
def broken_files(spark, d):
    from ..sources import json_records

    return json_records.broken_files(_shaped(spark, d))


@query("WITH n AS (SELECT * FROM nation WHERE n_regionkey < 3) SELECT 'm' || CAST(n_regionkey AS VARCHAR) AS file, CAST(n_nationkey AS VARCHAR) AS id FROM n")
def read_line_files(spark, d):
    """JSON Lines that are split by line."""
    from ..sources import json_records

    base = adapters.scratch(spark, "lines")
    for r in range(3):
        rows = table(spark, d, "nation").where(F.col("n_regionkey") == r).select("n_nationkey").collect()
        adapters.put_file(spark, f"{base}/deep/m{r}.json", "\n".join(f'{{"id": "{x[0]}"}}' for x in rows) + "\n\n[1]\nbroken")
    found = json_records.read_lines(spark, base)
    return found.select(F.regexp_extract("file", "([^/]*)[.]json$", 1).alias("file"), scalars.get("record", "id").alias("id"))


@query(
    """WITH f(path, mobile, kind) AS (VALUES ('Mobile/a/scenarios/s1.json', true, 'scenarios'), ('Mobile/a/joined.json', true, 'joined'), ('Fixed/b/scenarios/s2.json', false, 'scenarios'), ('Fixed/b/joined.json', false, 'joined'), ('top.json', false, 'none')),
m(mode) AS (VALUES ('all'), ('scenarios'), ('joined'), ('smart'))
SELECT mode, path, 'v' || path AS id FROM f, m WHERE mode = 'all' OR mode = kind OR (mode = 'smart' AND kind = CASE WHEN mobile THEN 'scenarios' ELSE 'joined' END)"""
)
def files_by_mode(spark, d):
    from ..sources import json_records

    base = adapters.scratch(spark, "modes")
    for name in ("Mobile/a/scenarios/s1.json", "Mobile/a/joined.json", "Fixed/b/scenarios/s2.json", "Fixed/b/joined.json", "top.json", "top.txt"):
        adapters.put_file(spark, f"{base}/{name}", f'[{{"id": "v{name}"}}]')
    out = None
    for mode in json_records.MODES:
        objects = json_records.read_objects(json_records.read_files(spark, base, mode=mode))
        found = objects.select(F.lit(mode).alias("mode"), F.substring_index("file", base.rpartition("/")[2] + "/", -1).alias("path"), scalars.get("record", "id").alias("id"))
        out = found if out is None else out.unionByName(found)
    return out


# --- topic documents --------------------------------------------------------


def _topic_files(spark: SparkSession, d: str) -> DataFrame:
    """A topic document per user; a third of them name a second id too often for the first to be taken."""
    i, u = F.col("event_id"), F.col("user_id")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    k = F.get_json_object("props", "$.k").cast("int")
    other = ((u % 3 == 0) & (i % 4 == 0)) | ((u % 3 == 1) & (i % 10 == 0))
    sid = u + F.when(other, 1000).otherwise(0)
    frame = F.when(i % 3 == 0, ', "frame_id": "rsu7"').otherwise("")
    address = text('"10.0.0.', i % 200, '"')
    by_type = {
        "view": ("/gps/cohda/fix", text('{"latitude": ', F.lit(50) + k / F.lit(128.0), ', "longitude": 6.5, "altitude": 100.0}')),
        "click": ("/gnss", text('{"latitude": ', F.lit(51) + k / F.lit(128.0), ', "longitude": 6.25}')),
        "purchase": ("/v2x/cam", text('{"header": {"message_id": 2, "station_id": {"value": ', sid, "}", frame, '}, "cam": {}}')),
        "signup": ("/v2x/denm", text('{"header": {"station_id": {"value": ', sid, '}}, "denm": {}}')),
        "error": ("/v2x/raw", F.when(i % 2 == 0, text('{"address": {"value": ', address, '}, "data": []}')).otherwise(text('{"address": ', address, ', "data": [1, 2]}'))),
    }
    topic, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (name, body) in by_type.items():
        topic, message = F.when(F.col("event_type") == kind, name).otherwise(topic), F.when(F.col("event_type") == kind, body).otherwise(message)
    topic = F.when(i % 17 == 0, "/other/status").otherwise(topic)
    entry = text('{"recording_timestamp_nsec": ', ns, ', "message": ', message, "}")
    rows = table(spark, d, "events").select(text("u", u).alias("file"), topic.alias("topic"), i.alias("i"), entry.alias("e"))
    joined = rows.groupBy("file", "topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "e"))), lambda x: x["e"]), ",\n").alias("e"))
    member = text('"', F.col("topic"), '": [', F.col("e"), "]")
    return joined.groupBy("file").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(member)), ",\n"), F.lit("}")).alias("value"))


_TOPICS = """WITH e AS (SELECT event_id AS i, user_id AS u, event_type AS t, CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_ms, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  user_id + CASE WHEN (user_id % 3 = 0 AND event_id % 4 = 0) OR (user_id % 3 = 1 AND event_id % 10 = 0) THEN 1000 ELSE 0 END AS sid FROM events WHERE event_id % 17 <> 0),
c AS (SELECT u, sid, count(*) AS n FROM e WHERE t IN ('purchase', 'signup') AND sid <> 0 GROUP BY 1, 2),
ids AS (SELECT u, CASE WHEN max(n) / CAST(sum(n) AS DOUBLE) > 0.8 THEN CAST(arg_max(sid, n) AS VARCHAR) ELSE 'unknown' END AS id FROM c GROUP BY 1),
pos AS (SELECT i, coalesce(id, 'unknown') AS vehicle_id, timestamp_ms, CASE t WHEN 'view' THEN 50 ELSE 51 END + k / 128.0::DOUBLE AS latitude, CASE t WHEN 'view' THEN 6.5 ELSE 6.25 END::DOUBLE AS longitude,
  CASE t WHEN 'view' THEN 100.0::DOUBLE END AS altitude, CASE t WHEN 'view' THEN '/gps/cohda/fix' ELSE '/gnss' END AS topic FROM e LEFT JOIN ids USING (u) WHERE t IN ('view', 'click')),
said AS (SELECT *, CASE t WHEN 'purchase' THEN '{"header": {"message_id": 2, "station_id": {"value": ' || sid || '}' || CASE WHEN i % 3 = 0 THEN ', "frame_id": "rsu7"' ELSE '' END || '}, "cam": {}}'
  WHEN 'signup' THEN '{"header": {"station_id": {"value": ' || sid || '}}, "denm": {}}'
  ELSE CASE WHEN i % 2 = 0 THEN '{"address": {"value": "10.0.0.' || (i % 200) || '"}, "data": []}' ELSE '{"address": "10.0.0.' || (i % 200) || '", "data": [1, 2]}' END END AS body FROM e WHERE t NOT IN ('view', 'click')),
msg AS (SELECT timestamp_ms, CASE WHEN t = 'error' OR sid = 0 THEN 'unknown' ELSE CAST(sid AS VARCHAR) END AS vehicle_id, CASE t WHEN 'purchase' THEN 'CAM' WHEN 'signup' THEN 'DENM' ELSE 'UNKNOWN' END AS message_type,
  length(body) AS message_size_bytes, CASE WHEN t = 'purchase' AND i % 3 = 0 THEN 'rsu7' WHEN t = 'error' THEN '10.0.0.' || (i % 200) END AS receiver_id,
  CASE t WHEN 'purchase' THEN '/v2x/cam' WHEN 'signup' THEN '/v2x/denm' ELSE '/v2x/raw' END AS topic FROM said)"""


def _topic_rows(spark, d, **how):
    from .runs import topic_entries, topic_rows

    return topic_rows(topic_entries(_topic_files(spark, d)), **how)


@query(_TOPICS + " SELECT vehicle_id, timestamp_ms, latitude, longitude, altitude, topic FROM pos")
def topic_positions(spark, d):
    return _topic_rows(spark, d)[0].select("vehicle_id", "timestamp_ms", "latitude", "longitude", "altitude", "topic")


@query(_TOPICS + " SELECT timestamp_ms, vehicle_id, message_type, CAST(message_size_bytes AS BIGINT) AS message_size_bytes, vehicle_id AS sender_id, receiver_id, topic FROM msg")
def topic_messages(spark, d):
    return _topic_rows(spark, d)[1].select("timestamp_ms", "vehicle_id", "message_type", "message_size_bytes", "sender_id", "receiver_id", "topic")


@query(_TOPICS + " SELECT nullif(vehicle_id, 'unknown') AS vehicle_id, timestamp_ms, latitude, topic FROM pos WHERE topic = '/gnss'")
def topic_demo(spark, d):
    return _topic_rows(spark, d, demo=True)[0].select("vehicle_id", "timestamp_ms", "latitude", "topic")


@query(
    _TOPICS
    + """ SELECT p.timestamp_ms, p.vehicle_id, p.latitude, p.longitude, p.altitude, count(m.timestamp_ms) AS messages_sent, CAST(coalesce(sum(m.message_size_bytes), 0) AS BIGINT) AS total_bytes_sent,
  coalesce(string_agg(DISTINCT m.message_type, ',' ORDER BY m.message_type), '') AS message_types
FROM pos p LEFT JOIN msg m ON m.vehicle_id = p.vehicle_id AND m.timestamp_ms BETWEEN p.timestamp_ms - 3600000 AND p.timestamp_ms + 3600000 GROUP BY p.i, 1, 2, 3, 4, 5"""
)
def topic_ingest(spark, d):
    """Topic documents taken through the topic plan, by way of landed rows, to fused rows."""
    from .runs import _landed, topic_entries, topic_rows, topic_tables

    base = adapters.scratch(spark, "topics")
    entries = _landed(topic_entries(_topic_files(spark, d)), f"{base}/entries")
    landed = [_landed(df, f"{base}/{n}") for n, df in zip(("gnss", "v2x"), topic_rows(entries), strict=True)]
    found = topic_tables(*landed, window_ms=WINDOW_MS)["fused_data"]
    return found.select("timestamp_ms", "vehicle_id", "latitude", "longitude", "altitude", "messages_sent", "total_bytes_sent", "message_types")


# --- writing and reading back -----------------------------------------------

_WRITTEN = ("timestamp_ms", "vehicle_id", "message_type", "message_size_bytes", "sender_id", "receiver_id", "latency_ms")
_WRITTEN_SQL = f"SELECT {', '.join(_WRITTEN)} FROM msg"


@query(_WRITTEN_SQL)
def write_read_parquet(spark, d):
    base = adapters.scratch(spark, "results")
    tables.write_results({"v2x_messages": messages(spark, d)}, base)
    return tables.read_results(spark, base, "v2x_messages", _WRITTEN)


@query(_WRITTEN_SQL)
def write_read_csv(spark, d):
    path = f"{adapters.scratch(spark, 'results')}/v2x_messages.csv"
    found = messages(spark, d).select(*_WRITTEN)
    tables.write(found, path, "csv")
    return spark.read.schema(found.schema).option("header", True).csv(path)


@query(_WRITTEN_SQL + " WHERE message_type = 'CAM'")
def write_read_partitioned(spark, d):
    path = f"{adapters.scratch(spark, 'results')}/by_type.parquet"
    tables.write(messages(spark, d).select(*_WRITTEN), path, partition_by=["message_type"])
    return spark.read.parquet(path).where("message_type = 'CAM'").select(*_WRITTEN)


@query(ORACLE["trajectory_samples"])
def export_samples(spark, d):
    path = f"{adapters.scratch(spark, 'export')}/trajectories.parquet"
    tables.export_samples(trajectory.trajectory_samples(positions(spark, d), step_ms=STEP_MS, gap_ms=GAP_MS), path)
    return rounded(spark.read.parquet(path).drop("x_m", "y_m"))


def _record_fusion(spark, d):
    side = messages(spark, d).select("vehicle_id", F.col("timestamp_ms").alias("timestamp_utc_ms"), "message_type", F.col("message_size_bytes").alias("payload_bytes"), "direction", "latency_ms")
    return fusion.fuse_records(samples(spark, d), side, tolerance_ms=TOLERANCE_MS), an.message_types(side)


@query(ORACLE["fuse_record_metrics"])
def export_fused(spark, d):
    path = f"{adapters.scratch(spark, 'export')}/fused.parquet"
    found, types = _record_fusion(spark, d)
    tables.export_fused(found, path, types)
    return rounded(spark.read.parquet(path).drop("x_m", "y_m"))


_BYTES = ", ".join(f"CAST(coalesce(sum(m.message_size_bytes) FILTER (m.direction = '{way}'), 0) AS BIGINT) AS {name}" for way, name in (("uplink_to_rsu", "tx_bytes"), ("downlink_from_rsu", "rx_bytes")))


@query(f"SELECT p.vehicle_id, p.timestamp_ms, {_BYTES} FROM pos p LEFT JOIN msg m ON m.vehicle_id = p.vehicle_id AND m.timestamp_ms BETWEEN p.timestamp_ms - 3600000 AND p.timestamp_ms + 3600000 GROUP BY 1, 2")
def export_csv(spark, d):
    base = adapters.scratch(spark, "export")
    tables.export_csv(base, fused=_record_fusion(spark, d)[0])
    found = spark.read.option("header", True).schema("vehicle_id string, timestamp_ms bigint, x_m double, y_m double, tx_bytes bigint, rx_bytes bigint").csv(f"{base}/fused.csv")
    return found.drop("x_m", "y_m")


@query("SELECT 'UTM' AS crs, 50.5::DOUBLE AS origin_lat_deg, 6.5::DOUBLE AS origin_lon_deg, CAST(10 AS INTEGER) AS hz, CAST(NULL AS VARCHAR) AS notes FROM (SELECT 1) WHERE true")
def run_metadata(spark, d):
    path = adapters.scratch(spark, "metadata")
    tables.metadata(spark, crs="UTM", origin_lat_deg=50.5, origin_lon_deg=6.5, hz=10).write.json(path)
    found = spark.read.schema(tables.METADATA).json(path)
    return found.select("crs", "origin_lat_deg", "origin_lon_deg", "hz", "notes")


@query(ORACLE["valid_vehicle_stats"])
def written_report(spark, d):
    """The three result tables written, then the report made of them, of which the vehicles are read back."""
    from . import runs

    base = adapters.scratch(spark, "report")
    made = {"trajectories": positions(spark, d), "v2x_messages": messages(spark, d), "fused_data": fused(spark, d)}
    tables.write_results(made, base)
    runs.write_report(spark, base)
    schema = "vehicle_id string, msg_count bigint, total_bytes bigint, mean_bytes double, first_ms bigint, last_ms bigint, duration_hours double"
    return rounded(spark.read.option("header", True).schema(schema).csv(f"{base}/vehicle_statistics.csv"))
