"""Gaps, smoothing, resampling and quality flags of position series.

Every window is partitioned by vehicle and ordered by (time, ordinal), so the
operators that follow one another share one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.savgol import hat_matrix, odd_window
from .filters import Cols

VALUES = ("latitude", "longitude", "altitude", "speed_mps", "heading_deg")
SMOOTHED = ("latitude", "longitude", "altitude")
GAP_MS, STEP_MS, LOW_SPEED_MPS = 5000, 1000, 1.0


def by_time(cols: Cols = Cols()) -> WindowSpec:
    return Window.partitionBy(cols.vehicle).orderBy(cols.ts, cols.order)


def sort_by_time(df: DataFrame, cols: Cols = Cols()) -> DataFrame:
    return df.orderBy(cols.ts, cols.order)


def with_gaps(df: DataFrame, *, gap_ms: int = GAP_MS, cols: Cols = Cols()) -> DataFrame:
    """Adds gap_before, gap_after, at_gap (either) and segment, counted from 0 in each vehicle. A gap is longer than gap_ms."""
    w, ts = by_time(cols), F.col(cols.ts)
    before = F.coalesce(ts - F.lag(ts).over(w) > gap_ms, F.lit(False))
    after = F.coalesce(F.lead(ts).over(w) - ts > gap_ms, F.lit(False))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.withColumn("gap_before", before)
        .withColumn("gap_after", after)
        .withColumn("at_gap", F.col("gap_before") | F.col("gap_after"))
        .withColumn("segment", F.sum(F.col("gap_before").cast("bigint")).over(running))
    )


def gaps(df: DataFrame, *, gap_ms: int = GAP_MS, cols: Cols = Cols()) -> DataFrame:
    """One row per gap: vehicle, start_index, start_ms, end_ms."""
    w, ts = by_time(cols), F.col(cols.ts)
    pairs = df.select(cols.vehicle, (F.row_number().over(w) - 1).cast("bigint").alias("start_index"), ts.alias("start_ms"), F.lead(ts).over(w).alias("end_ms"))
    return pairs.where(F.col("end_ms") - F.col("start_ms") > gap_ms)


def time_deltas(df: DataFrame, *, cols: Cols = Cols(), partitioned: bool = True) -> DataFrame:
    """Adds delta_s to the row before: of the same vehicle, or of the whole table in time order, which one task sorts."""
    w = by_time(cols) if partitioned else Window.orderBy(cols.ts, cols.order)
    return df.withColumn("delta_s", (F.col(cols.ts) - F.lag(cols.ts).over(w)) / 1000.0)


def smooth(df: DataFrame, *, values: tuple[str, ...] = SMOOTHED, window: int = 7, degree: int = 2, gap_ms: int = GAP_MS, cols: Cols = Cols()) -> DataFrame:
    """Replaces values by their Savitzky-Golay fit within each segment.

    The ends of a segment take the fit of its first or last window. A segment or
    vehicle of fewer rows than the window stays as it is, and so does the last
    row before each gap, which is no part of what is fitted. A null makes every
    fit null whose window holds it.
    """
    size = odd_window(window)
    half, weights = size // 2, hat_matrix(size, degree)
    held = with_gaps(df, gap_ms=gap_ms, cols=cols)
    alone = F.col("gap_after")
    part = Window.partitionBy(cols.vehicle, "segment", "__alone")
    held = held.withColumn("__alone", alone).withColumn("__total", F.count(F.lit(1)).over(Window.partitionBy(cols.vehicle)))
    inner = part.orderBy(cols.ts, cols.order)
    held = held.withColumn("__i", F.row_number().over(inner) - 1).withColumn("__n", F.count(F.lit(1)).over(part))
    shifts = range(1 - size, size)
    for name in values:
        at = {k: (F.lag(name, -k) if k < 0 else F.lead(name, k)).over(inner).alias(f"__{name}_{k + size}") for k in shifts if k}
        held = held.select("*", *at.values())
    read = lambda name, k: F.col(f"__{name}_{k + size}") if k else F.col(name)

    def fit(name: str, row: int) -> Column:
        total = None
        for j in range(size):
            term = read(name, j - row) * F.lit(float(weights[row, j]))
            total = term if total is None else total + term
        return total

    fitted = {}
    for name in values:
        out = F.when((F.col("__total") < size) | (F.col("__n") < size) | F.col("__alone"), F.col(name))
        for i in range(half):
            out = out.when(F.col("__i") == i, fit(name, i))
            out = out.when(F.col("__i") == F.col("__n") - 1 - i, fit(name, size - 1 - i))
        fitted[name] = out.otherwise(fit(name, half))
    return held.select(*[fitted[c].alias(c) if c in fitted else F.col(c) for c in df.columns])


def resample(df: DataFrame, *, values: tuple[str, ...] = VALUES, step_ms: int = STEP_MS, gap_ms: int = GAP_MS, cols: Cols = Cols()) -> DataFrame:
    """Vehicle, grid time, interpolated values and gap_flag, on a grid of step_ms from each vehicle's first row.

    Each row emits the grid points up to the next row, so no grid is joined: one
    shuffle, output bounded by the covered time over the step. Between the two
    rows of a gap nothing is emitted; of equal times the last row counts; a null
    on either side of a grid point makes its value null, unless it lies on a row.
    gap_flag marks points within a step of a gap.
    """
    w, ts, step = by_time(cols), F.col(cols.ts), F.lit(step_ms).cast("bigint")
    past, ahead = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(cols.vehicle).orderBy(F.col(cols.ts).desc(), F.col(cols.order).desc())
    held = with_gaps(df, gap_ms=gap_ms, cols=cols).select(
        cols.vehicle,
        ts.alias("__t"),
        "gap_after",
        *[F.col(v) for v in values],
        *[F.lead(v).over(w).alias(f"__next_{v}") for v in values],
        F.lead(ts).over(w).alias("__u"),
        F.first(ts).over(past).alias("__t0"),
        F.max(F.when(F.col("gap_before"), ts)).over(past).alias("__gap_end"),
        F.min(F.when(F.col("gap_after"), ts)).over(ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__gap_start"),
    )
    t, u, t0 = F.col("__t"), F.col("__u"), F.col("__t0")
    lo = t0 + F.ceil((t - t0) / step) * step
    hi = F.when(u.isNull() | F.col("gap_after"), t).otherwise(u - 1)
    points = held.withColumn("__lo", lo).withColumn("__hi", hi).where("__lo <= __hi").withColumn("__g", F.explode(F.sequence("__lo", "__hi", step)))
    g = F.col("__g")

    def value(name: str) -> Column:
        y, z = F.col(name), F.col(f"__next_{name}")
        return F.when(g == t, y).otherwise(y + (z - y) * (g - t) / (u - t)).alias(name)

    near = F.coalesce(g <= F.col("__gap_end") + step, F.lit(False)) | F.coalesce(g >= F.col("__gap_start") - step, F.lit(False))
    return points.select(cols.vehicle, g.alias(cols.ts), *[value(v) for v in values], near.alias("gap_flag"))


def quality(gap: Column, extrapolated: Column, speed: Column, *, low_speed: float = LOW_SPEED_MPS) -> Column:
    """Struct of three flags; a missing speed is not low."""
    slow = F.coalesce(speed < low_speed, F.lit(False)) & ~F.coalesce(F.isnan(speed), F.lit(False))
    return F.struct(gap.alias("gap"), extrapolated.alias("extrapolated"), slow.alias("low_speed"))


def map_class(flags: str = "quality") -> Column:
    """How a sample is drawn: gap before low_speed before normal."""
    return F.when(F.col(f"{flags}.gap"), "gap").when(F.col(f"{flags}.low_speed"), "low_speed").otherwise("normal")


def trajectory_samples(
    df: DataFrame, *, step_ms: int = STEP_MS, gap_ms: int = GAP_MS, smoothing: bool = True, window: int = 7, degree: int = 2, low_speed: float = LOW_SPEED_MPS, cols: Cols = Cols()
) -> DataFrame:
    """All vehicles' trajectories: smoothed, on the grid, flagged; x_m and y_m are 0 until a projection fills them.

    No emitted sample is extrapolated: the grid ends at each vehicle's last row.
    """
    smoothed = smooth(df, window=window, degree=degree, gap_ms=gap_ms, cols=cols) if smoothing else df
    grid = resample(smoothed, step_ms=step_ms, gap_ms=gap_ms, cols=cols)
    return grid.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col(cols.vehicle).alias("vehicle_id"),
        F.col(cols.ts).alias("timestamp_ms"),
        F.col("latitude").alias("lat_deg"),
        F.col("longitude").alias("lon_deg"),
        F.col("altitude").alias("alt_m"),
        F.lit(0.0).alias("x_m"),
        F.lit(0.0).alias("y_m"),
        "speed_mps",
        "heading_deg",
        quality(F.col("gap_flag"), F.lit(False), F.col("speed_mps"), low_speed=low_speed).alias("quality"),
    )


def expected_samples(df: DataFrame, *, step_ms: int = STEP_MS, cols: Cols = Cols()) -> int:
    """Upper bound of the samples that resample would emit, to be looked at before it runs."""
    spans = df.groupBy(cols.vehicle).agg((F.max(cols.ts) - F.min(cols.ts)).alias("span"))
    return spans.agg(F.sum(F.floor(F.col("span") / step_ms) + 1)).first()[0] or 0
