"""Joins of positions with messages: time bands, nearest in time, near in space and time.

All are equi-joins on a vehicle and a slice of time. A slice bounds what meets
in one task, so a vehicle that holds a large share of all rows, such as
"unknown", is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalars import floor_div


def band_join(points: DataFrame, messages: DataFrame, *, half_ms: int, measures: Sequence[Column], by: Sequence[str] = (), vehicle: str = "vehicle_id", ts: str = "timestamp_ms", message_ts: str = "message_ts") -> DataFrame:
    """Every row of points with measures over the messages of its vehicle within half_ms either way, bounds included; by: columns of messages that part the measures.

    points rows must differ (an ordinal makes them). A point falls into at most
    two slices, each message into one, so a pair meets once; measures are summed
    per slice before the point's slices meet.
    """
    width = 2 * half_ms + 1
    own = [c for c in points.columns]
    left = points.withColumn(
        "__slice",
        F.explode(F.array_distinct(F.array(floor_div(F.col(ts) - half_ms, width), floor_div(F.col(ts) + half_ms, width)))),
    )
    right = messages.withColumn("__slice", floor_div(F.col(message_ts), width)).withColumnRenamed(vehicle, "__vehicle")
    near = right[message_ts].between(left[ts] - half_ms, left[ts] + half_ms)
    right_slice = right["__slice"]
    joined = left.join(right, (left[vehicle] == right["__vehicle"]) & (left["__slice"] == right_slice) & near, "left")
    return joined.groupBy(*[left[c] for c in own], *[right[c] for c in by]).agg(*measures)


def fuse_topics(points: DataFrame, messages: DataFrame, *, window_ms: int = 1000) -> DataFrame:
    """Positions with what was sent around them: messages_sent, total_bytes_sent, avg_latency_ms, message_types."""
    side = messages.select("vehicle_id", F.col("timestamp_ms").alias("message_ts"), "message_type", "message_size_bytes", "latency_ms")
    measures = [
        F.count("message_ts").alias("messages_sent"),
        F.coalesce(F.sum("message_size_bytes"), F.lit(0)).cast("bigint").alias("total_bytes_sent"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.array_join(F.array_sort(F.collect_set("message_type")), ",").alias("message_types"),
    ]
    keep = [c for c in ("timestamp_ms", "vehicle_id", "latitude", "longitude", "altitude", "speed_mps", "heading_deg", "ordinal") if c in points.columns]
    return band_join(points.select(*keep), side, half_ms=window_ms // 2, measures=measures)


def message_time(messages: DataFrame) -> Column:
    """The first of record, send and receive time that is set and not 0."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit(0)) for c in ("timestamp_utc_ms", "tx_timestamp_utc_ms", "rx_timestamp_utc_ms") if c in messages.columns])


def fuse_records(samples: DataFrame, messages: DataFrame, *, tolerance_ms: int = 500) -> DataFrame:
    """Samples with tx_bytes, rx_bytes, avg_latency_ms and msg_counts of their vehicle's messages within the tolerance."""
    side = messages.select("vehicle_id", message_time(messages).alias("message_ts"), "message_type", "payload_bytes", "direction", "latency_ms")
    side = side.where(F.col("message_ts").isNotNull())
    total = lambda way: F.coalesce(F.sum(F.when(F.col("direction").contains(way), F.coalesce("payload_bytes", F.lit(0)))), F.lit(0)).cast("bigint")
    measures = [
        total("uplink").alias("__tx"),
        total("downlink").alias("__rx"),
        F.sum("latency_ms").alias("__latency"),
        F.count("latency_ms").alias("__timed"),
        F.count("message_type").alias("__n"),
    ]
    points = samples.select("vehicle_id", "timestamp_ms", "x_m", "y_m")
    found = band_join(points, side, half_ms=tolerance_ms, measures=measures, by=["message_type"])
    kinds = F.collect_list(F.when(F.col("__n") > 0, F.struct("message_type", "__n")))  # a row for each type
    return found.groupBy(*points.columns).agg(
        F.sum("__tx").alias("tx_bytes"),
        F.sum("__rx").alias("rx_bytes"),
        F.try_divide(F.sum("__latency"), F.sum("__timed")).alias("avg_latency_ms"),
        F.map_from_entries(F.array_sort(kinds)).alias("msg_counts"),
    )


def nearest_join(left: DataFrame, right: DataFrame, *, tolerance_ms: int, vehicle: str = "vehicle_id", ts: str = "timestamp_ms", order: str = "ordinal", take: Sequence[str] = ()) -> DataFrame:
    """Every row of left with the row of right of its vehicle that is nearest in time, within the tolerance, or nulls.

    Adds match_ts and the columns in take, as <name>_y where left has the name.
    Of two equally near the earlier counts; of equal times the last row looking
    back and the first looking ahead, by order. Rows of both sides are merged
    and sorted by slice of time; right rows are copied to the slices within the
    tolerance, so slices need no neighbour.
    """
    width = max(64 * tolerance_ms, 60_000)
    names = {c: f"{c}_y" if c in left.columns else c for c in take}
    packed = F.struct(F.col(ts).alias("t"), F.col(order).alias("o"), *[F.col(c).alias(f"v_{c}") for c in take])
    a = left.select(F.col(vehicle).alias("__v"), floor_div(F.col(ts), width).alias("__slice"), F.col(ts).alias("__t"), F.struct("*").alias("__row"))
    reach = F.array_distinct(F.array(*[floor_div(F.col(ts) + d, width) for d in (-tolerance_ms, 0, tolerance_ms)]))
    b = right.select(F.col(vehicle).alias("__v"), F.explode(reach).alias("__slice"), F.col(ts).alias("__t"), packed.alias("__r"))
    both = a.unionByName(b, allowMissingColumns=True)
    part = Window.partitionBy("__v", "__slice")
    upto = (Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("__back", F.max("__r").over(part.orderBy("__t").rangeBetween(*upto)))
    both = both.withColumn("__ahead", F.min("__r").over(part.orderBy(F.col("__t").desc()).rangeBetween(*upto)))
    rows = both.where(F.col("__row").isNotNull())
    d_back, d_ahead = F.col("__t") - F.col("__back.t"), F.col("__ahead.t") - F.col("__t")
    near = F.when(d_back.isNotNull() & (d_ahead.isNull() | (d_back <= d_ahead)), F.col("__back")).otherwise(F.col("__ahead"))
    rows = rows.withColumn("__m", near).withColumn("__m", F.when(F.abs(F.col("__m.t") - F.col("__t")) <= tolerance_ms, F.col("__m")))
    return rows.select("__row.*", F.col("__m.t").alias("match_ts"), *[F.col(f"__m.v_{c}").alias(names[c]) for c in take])


def match_rate(joined: DataFrame, column: str = "match_ts") -> DataFrame:
    return joined.agg(
        F.count(F.lit(1)).alias("total"), F.count(column).alias("matched"), F.try_divide(F.count(column).cast("double"), F.count(F.lit(1))).alias("match_rate")
    )


def spatiotemporal_match(points: DataFrame, known: DataFrame, *, max_ms: int = 5000, max_m: float = 100.0) -> DataFrame:
    """Positions with the id, time difference and distance of the known vehicle nearest in (time, space), if any within both bounds.

    The equi keys are a slice of time, a row of latitude and a cell of longitude,
    all at least as wide as the bounds; a row has as many cells as fit around it
    at its end nearer to the pole, so cells meet across 180 degrees too.
    """
    band = max_m / 110_000.0
    edge = F.least(F.greatest(F.abs(F.col("__row")), F.abs(F.col("__row") + 1)) * (2 * band) + 2 * band, F.lit(90.0))
    cells = F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(edge)) / (2 * band)))
    cell = lambda lon: F.pmod(F.floor((lon + 180.0) / (360.0 / F.col("__cells"))), F.col("__cells"))
    reach = F.explode(F.array_distinct(F.array(*[floor_div(F.col("k_ts") + d, 2 * max_ms + 1) for d in (-max_ms, max_ms)])))
    rows = F.explode(F.array_distinct(F.array(*[F.floor((F.col("k_lat") + d) / (2 * band)) for d in (-band, band)])))
    side = known.where(F.col("vehicle_id") != "unknown").select(F.col("vehicle_id").alias("matched_id"), F.col("timestamp_ms").alias("k_ts"), F.col("latitude").alias("k_lat"), F.col("longitude").alias("k_lon"))
    side = side.withColumn("__slice", reach).withColumn("__row", rows).withColumn("__cells", cells)
    around = F.array_distinct(F.array(*[cell(F.col("k_lon") + d * (180.0 / F.col("__cells"))) for d in (-1, 1)]))
    side = side.withColumn("__cell", F.explode(around)).drop("__cells")
    left = points.withColumn("__slice", floor_div(F.col("timestamp_ms"), 2 * max_ms + 1)).withColumn("__row", F.floor(F.col("latitude") / (2 * band)))
    left = left.withColumn("__cells", cells).withColumn("__cell", cell(F.col("longitude"))).drop("__cells")
    dt = F.abs(F.col("timestamp_ms") - F.col("k_ts"))
    meters = geo.haversine_m(F.col("latitude"), F.col("longitude"), F.col("k_lat"), F.col("k_lon"))
    pairs = left.join(side, ["__slice", "__row", "__cell"]).withColumn("dt_ms", dt).withColumn("dist_m", meters).where((F.col("dt_ms") <= max_ms) & (F.col("dist_m") < max_m))
    best = pairs.groupBy("ordinal").agg(F.min(F.struct("dt_ms", "dist_m", "matched_id")).alias("b"))
    best = best.select("ordinal", F.col("b.matched_id").alias("matched_id"), F.col("b.dt_ms").alias("dt_ms"), F.col("b.dist_m").alias("dist_m"))
    return points.join(best, "ordinal", "left")
