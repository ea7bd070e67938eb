"""Questions asked of the result tables, each a DataFrame -> DataFrame function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalars import floor_div

TS, VEHICLE = "timestamp_ms", "vehicle_id"


def at(ts: str = TS) -> Column:
    return F.timestamp_millis(F.col(ts))


def hour_of(ts: str = TS) -> Column:
    """Hour of the day in UTC, whatever the session's zone."""
    return floor_div(F.pmod(F.col(ts), F.lit(86_400_000).cast("bigint")), 3_600_000).cast("int")


def date_of(ts: str = TS) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), floor_div(F.col(ts), 86_400_000).cast("int"))


def kbps(bytes_: Column, minutes: Column) -> Column:
    """Kilobits a second; null where no time passed."""
    return F.try_divide(bytes_ * 8 / 1000.0, F.nullif(minutes * 60, F.lit(0.0)))


#: Values that are fetched at once, and bins of a pass over more of them, when a quantile is looked for.
FETCHED, BINS = 100_000, 1000


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, by as many passes as it takes to narrow the values around each rank down to few.

    A pass counts by bin, so nothing grows with the number of distinct values:
    neither an aggregate's state nor a sort.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    n, low, high = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    fetched: dict[tuple[float, float], list[float]] = {}

    def value_at(rank: int, low: float, high: float, many: int) -> float:
        """The value of a rank among the many values from low to high."""
        while low < high and many > FETCHED:
            step = F.least(F.floor((F.col("v") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
            bins = values.where(F.col("v").between(low, high)).groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            for b in sorted(bins.collect(), key=lambda r: r["b"]):
                if rank < b["n"]:
                    low, high, many = b["low"], b["high"], b["n"]
                    break
                rank -= b["n"]
        if low < high and (low, high) not in fetched:
            fetched[low, high] = sorted(r["v"] for r in values.where(F.col("v").between(low, high)).collect())
        return fetched[low, high][rank] if low < high else low

    out = []
    for share in shares:
        place = share * (n - 1)
        a = value_at(int(place), low, high, n)
        b = value_at(min(int(place) + 1, n - 1), low, high, n) if place > int(place) else a
        out.append(a + (b - a) * (place - int(place)))
    return out


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std (of a sample), min, exact quartiles with linear interpolation, max."""
    named = zip(("p25", "p50", "p75"), quantiles(df, column, (0.25, 0.5, 0.75)), strict=True)
    found = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"))
    q = [F.lit(v).cast("double").alias(name) for name, v in named]
    return found.select("count", "mean", "std", "min", *q, "max")


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows of largest value; equal values by the tie columns, ascending."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def run_stats(points: DataFrame, messages: DataFrame, fused: DataFrame, total_files: int | None = None) -> DataFrame:
    sides = points.agg(F.count(F.lit(1)).alias("trajectory_points"), F.countDistinct(VEHICLE).alias("unique_vehicles")).join(
        messages.agg(F.count(F.lit(1)).alias("v2x_messages"), F.coalesce(F.sum("message_size_bytes"), F.lit(0)).alias("total_bytes_sent"), F.coalesce(F.avg("message_size_bytes"), F.lit(0.0)).alias("avg_message_size"))
    )
    out = sides.join(fused.agg(F.count(F.lit(1)).alias("fused_points")))  # one row each
    return out if total_files is None else out.withColumn("total_files", F.lit(total_files))


def trajectory_totals(points: DataFrame) -> DataFrame:
    return points.agg(
        F.count(F.lit(1)).alias("points"), F.countDistinct(VEHICLE).alias("vehicles"), ((F.max(TS) - F.min(TS)) / 60000.0).alias("span_min")
    )


def value_counts(df: DataFrame, column: str = "message_type") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.col("count").desc(), column)


def message_sizes(messages: DataFrame) -> DataFrame:
    size = F.col("message_size_bytes")
    return messages.agg(F.sum(size).alias("total_bytes"), (F.sum(size) / (1024.0 * 1024.0)).alias("total_mb"), F.avg(size).alias("mean_bytes"), F.min(size).alias("min_bytes"), F.max(size).alias("max_bytes"))


def per_vehicle(df: DataFrame, name: str = "n") -> DataFrame:
    return df.groupBy(VEHICLE).agg(F.count(F.lit(1)).alias(name))


def per_vehicle_summary(df: DataFrame) -> DataFrame:
    counts = per_vehicle(df)
    median = F.lit(quantiles(counts, "n", [0.5])[0]).cast("double").alias("median")
    return counts.agg(F.avg("n").alias("mean"), F.max("n").alias("max")).select("mean", median, "max")


def active_share(fused: DataFrame) -> DataFrame:
    """Share of points with messages, sums over all and means over the active ones."""
    active = F.col("messages_sent") > 0
    return fused.agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(active).alias("active_points"),
        F.try_divide(F.count_if(active) * 100.0, F.count(F.lit(1))).alias("active_pct"),
        F.sum("messages_sent").alias("messages"),
        F.sum("total_bytes_sent").alias("bytes"),
        F.avg(F.when(active, F.col("messages_sent"))).alias("mean_messages_active"),
        F.avg(F.when(active, F.col("total_bytes_sent"))).alias("mean_bytes_active"),
    )


def vehicle_rates(fused: DataFrame) -> DataFrame:
    """Per vehicle: points, first and last time, messages, bytes, duration and data rate."""
    found = fused.groupBy(VEHICLE).agg(
        F.count(F.lit(1)).alias("points"), F.min(TS).alias("first_ms"), F.max(TS).alias("last_ms"), F.sum("messages_sent").alias("messages_sent"), F.sum("total_bytes_sent").alias("total_bytes_sent")
    )
    found = found.withColumn("duration_min", (F.col("last_ms") - F.col("first_ms")) / 60000.0)
    return found.withColumn("data_rate_kbps", kbps(F.col("total_bytes_sent"), F.col("duration_min")))


def vehicle_spans(df: DataFrame) -> DataFrame:
    """Known vehicles' rows and the seconds from first to last."""
    found = df.where(F.col(VEHICLE) != "unknown").groupBy(VEHICLE)
    return found.agg(F.count(F.lit(1)).alias("points"), F.min(TS).alias("first_ms"), F.max(TS).alias("last_ms"), ((F.max(TS) - F.min(TS)) / 1000.0).alias("span_s"))


def geo_extent(points: DataFrame) -> DataFrame:
    cols = ("latitude", "longitude", "altitude")
    return points.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])


def hourly(df: DataFrame, measures: Sequence[Column]) -> DataFrame:
    return df.groupBy(hour_of().alias("hour")).agg(*measures)


def hourly_messages(messages: DataFrame) -> DataFrame:
    return hourly(messages, [F.count(F.lit(1)).alias("messages"), F.sum("message_size_bytes").alias("bytes"), F.avg("message_size_bytes").alias("mean_bytes")])


def hourly_sent(fused: DataFrame) -> DataFrame:
    return hourly(fused, [F.sum("messages_sent").alias("messages_sent")])


def daily_volume(messages: DataFrame, n: int | None = None) -> DataFrame:
    found = messages.groupBy(date_of().cast("string").alias("date")).agg(F.count(F.lit(1)).alias("messages"), F.sum("message_size_bytes").alias("bytes"))
    found = found.orderBy("date")
    return found.limit(n) if n else found


def date_type_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy(date_of().cast("string").alias("date"), "message_type").agg(F.count(F.lit(1)).alias("messages"))


def vehicle_behaviour(fused: DataFrame) -> DataFrame:
    """Per vehicle: messages, bytes, and how far it moves in degrees."""
    found = fused.groupBy(VEHICLE).agg(
        F.sum("messages_sent").alias("messages_sum"),
        F.avg("messages_sent").alias("messages_mean"),
        F.stddev_samp("messages_sent").alias("messages_std"),
        F.sum("total_bytes_sent").alias("bytes_sum"),
        *[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("min", F.min), ("max", F.max))],
    )
    lat, lon = F.col("max_latitude") - F.col("min_latitude"), F.col("max_longitude") - F.col("min_longitude")
    return found.withColumn("lat_range", lat).withColumn("lon_range", lon).withColumn("mobility_range", F.hypot(lat, lon))


def message_type_stats(messages: DataFrame) -> DataFrame:
    size = "message_size_bytes"
    return messages.groupBy("message_type").agg(
        F.count(F.lit(1)).alias("messages"), F.avg(size).alias("mean_bytes"), F.stddev_samp(size).alias("std_bytes"), F.min(size).alias("min_bytes"), F.max(size).alias("max_bytes"), F.sum(size).alias("sum_bytes")
    )


def grid_stats(fused: DataFrame, *, size: float = 0.001, active: bool = False) -> DataFrame:
    """Per grid cell: messages, bytes, points and vehicles; active keeps cells with messages."""
    cells = fused.groupBy(geo.grid_cell(F.col("latitude"), size).alias("lat_cell"), geo.grid_cell(F.col("longitude"), size).alias("lon_cell")).agg(
        F.sum("messages_sent").alias("total_messages"), F.sum("total_bytes_sent").alias("total_bytes"), F.count(F.lit(1)).alias("points"), F.countDistinct(VEHICLE).alias("vehicles")
    )
    return cells.where("total_messages > 0") if active else cells


def valid_vehicle_stats(messages: DataFrame) -> DataFrame:
    size = "message_size_bytes"
    found = messages.where(F.col(VEHICLE) != "unknown").groupBy(VEHICLE).agg(
        F.count(F.lit(1)).alias("msg_count"), F.sum(size).alias("total_bytes"), F.avg(size).alias("mean_bytes"), F.min(TS).alias("first_ms"), F.max(TS).alias("last_ms")
    )
    return found.withColumn("duration_hours", (F.col("last_ms") - F.col("first_ms")) / 3600000.0)


def link_stats(messages: DataFrame) -> DataFrame:
    """Per sender and receiver; messages without either form no link."""
    found = messages.where(F.col("sender_id").isNotNull() & F.col("receiver_id").isNotNull()).groupBy("sender_id", "receiver_id")
    return found.agg(F.count(F.lit(1)).alias("messages"), F.sum("message_size_bytes").alias("bytes"), F.avg("latency_ms").alias("mean_latency_ms"))


def speed_correlation(fused: DataFrame) -> DataFrame:
    return fused.agg(F.corr("speed_mps", "messages_sent").alias("corr"), F.count("speed_mps").alias("n"))


def speed_buckets(fused: DataFrame, width: float = 5.0) -> DataFrame:
    bucket = F.floor(F.col("speed_mps") / width).cast("bigint")
    found = fused.where(F.col("speed_mps").isNotNull()).groupBy(bucket.alias("bucket"))
    return found.agg(F.count(F.lit(1)).alias("points"), F.sum("messages_sent").alias("messages"), F.avg("messages_sent").alias("mean_messages"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) as (column_name, nulls)")


def heatmap(fused: DataFrame, value: Column, how: str, *, lat: str = "latitude", lon: str = "longitude", edges: int = 50, over: DataFrame | None = None) -> DataFrame:
    """Per spatial bin (lat_bin, lon_bin) a mean or a sum.

    edges equally spaced bounds span the table; bins are half open, so rows on
    the upper bound fall outside. A mean counts the rows whose value is not
    null; its empty bins are absent, as are those of a sum, which stand for 0.
    over is the table whose bounds count: the positions that fused was made of
    have the same ones and cost no second join.
    """
    bounds = (fused if over is None else over).agg(F.min(lat).alias("a0"), F.max(lat).alias("a1"), F.min(lon).alias("b0"), F.max(lon).alias("b1"))
    rows = fused.withColumn("__v", value).where(F.col("__v").isNotNull()).join(F.broadcast(bounds))  # one row
    cell = lambda c, lo, hi: F.floor((F.col(c) - F.col(lo)) * (edges - 1) / F.nullif(F.col(hi) - F.col(lo), F.lit(0.0))).cast("bigint")
    rows = rows.where((F.col(lat) < F.col("a1")) & (F.col(lon) < F.col("b1")))
    agg = {"mean": F.avg, "sum": F.sum}[how]("__v").alias("value")
    return rows.groupBy(cell(lat, "a0", "a1").alias("lat_bin"), cell(lon, "b0", "b1").alias("lon_bin")).agg(agg, F.count(F.lit(1)).alias("rows"))


def throughput_series(fused: DataFrame, *, step_ms: int = 1000, tx: str = "tx_bytes", rx: str = "rx_bytes", vehicle: str | None = None) -> DataFrame:
    """Bytes by time step, over all vehicles or one."""
    rows = fused if vehicle is None else fused.where(F.col(VEHICLE) == vehicle)
    return rows.groupBy(floor_div(F.col(TS), step_ms).alias("step")).agg(F.sum(tx).alias("tx_bytes"), F.sum(rx).alias("rx_bytes"))


def vehicle_series(fused: DataFrame, vehicle: str, columns: Sequence[str]) -> DataFrame:
    return fused.where(F.col(VEHICLE) == vehicle).select(TS, *columns).orderBy(TS)


def id_share(messages: DataFrame) -> DataFrame:
    """How many messages have an id, and how many ids there are."""
    known = F.col(VEHICLE) != "unknown"
    return messages.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(known).alias("with_id"), F.try_divide(F.count_if(known) * 100.0, F.count(F.lit(1))).alias("with_id_pct"), F.countDistinct(F.when(known, F.col(VEHICLE))).alias("ids")
    )


def message_types(messages: DataFrame) -> list[str]:
    """The types that occur, sorted; they are few."""
    return [r["message_type"] for r in messages.where("message_type is not null").select("message_type").distinct().orderBy("message_type").collect()]


def type_counts_wide(fused: DataFrame, types: Sequence[str] | None = None, *, column: str = "msg_counts") -> DataFrame:
    """fused with one bigint column msg_count_<type> per type in place of the map.

    types are those of the messages that fused was made of; without them fused is
    read once more for the types that occur in it, so it had better be written.
    """
    if types is None:
        types = [r["t"] for r in fused.select(F.explode(F.map_keys(column)).alias("t")).distinct().orderBy("t").collect()]
    wide = [F.coalesce(F.try_element_at(column, F.lit(t)), F.lit(0)).cast("bigint").alias(f"msg_count_{t}") for t in types]
    return fused.select(*[c for c in fused.columns if c != column], *wide)


def majority_ids(ids: DataFrame, *, file: str = "file", vehicle: str = "vehicle_id", share: float = 0.8) -> DataFrame:
    """Per file the id that more than share of its identified messages carry, else 'unknown'; counted by file and id before files are looked at."""
    counts = ids.where(F.col(vehicle).isNotNull()).groupBy(file, vehicle).count()
    best = counts.groupBy(file).agg(F.max_by(vehicle, "count").alias("id"), (F.max("count") / F.sum("count")).alias("share"))
    return best.select(file, F.when(F.col("share") > share, F.col("id")).otherwise("unknown").alias(vehicle))


def time_deltas(df: DataFrame, *, slice_ms: int = 3_600_000) -> DataFrame:
    """delta_s: the seconds between consecutive rows of the whole table in time order, null for the first.

    Rows follow each other within a slice of time; from slice to slice the last
    and first times do, of which there is one row a slice.
    """
    rows = df.select(F.col(TS), floor_div(F.col(TS), slice_ms).alias("slice"))
    inner = rows.select((F.col(TS) - F.lag(TS).over(Window.partitionBy("slice").orderBy(TS))).alias("d")).where("d is not null")
    edges = rows.groupBy("slice").agg(F.min(TS).alias("first"), F.max(TS).alias("last"))
    outer = edges.select((F.col("first") - F.lag("last").over(Window.orderBy("slice"))).alias("d"))
    return inner.unionByName(outer).select((F.col("d") / 1000.0).alias("delta_s"))


def delta_stats(df: DataFrame) -> DataFrame:
    """describe() of the seconds between consecutive rows of the whole table in time order."""
    return describe(time_deltas(df), "delta_s")
