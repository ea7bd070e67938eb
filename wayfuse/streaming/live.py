"""Streaming forms: tracks cut at gaps, and positions joined with messages near in time.

Both streams need an event time column `ts` (timestamp). State is bounded by the
watermark; rows later than it are dropped, as Structured Streaming defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(points: DataFrame, *, gap: str = "5 seconds", late: str = "1 minute", vehicle: str = "vehicle_id") -> DataFrame:
    """Per vehicle and stretch without a gap: start, end of the last row plus the gap, and number of rows."""
    found = points.withWatermark("ts", late).groupBy(vehicle, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("points"))
    return found.select(vehicle, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "points")


def band_matches(points: DataFrame, messages: DataFrame, *, half_ms: int = 500, late: str = "1 minute", vehicle: str = "vehicle_id") -> DataFrame:
    """Pairs of a position and a message of its vehicle within half_ms either way; both sides' state is dropped behind the watermark."""
    left = points.withWatermark("ts", late)
    right = messages.withColumnRenamed("ts", "message_ts").withColumnRenamed(vehicle, "message_vehicle").withWatermark("message_ts", late)
    reach = F.expr(f"INTERVAL {half_ms} MILLISECONDS")
    near = F.col("message_ts").between(F.col("ts") - reach, F.col("ts") + reach)
    return left.join(right, (F.col(vehicle) == F.col("message_vehicle")) & near).drop("message_vehicle")
