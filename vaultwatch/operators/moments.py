"""Windowed temperature statistics, daily moments, and their roll-up to wider windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.functions.eventtime import event_time_filter, grid_start, in_windows, key_start, start_ms, window_key
from vaultwatch.functions.exact import exact_sum, exact_unit

VAULT_RANGE = (1000, 1020)
TEMPERATURE = "s194_temperature_celsius"


def in_range(df: DataFrame, bounds: tuple[int, int] | None, key: str = "vault_id", ts: str = "ts", value: str = TEMPERATURE) -> DataFrame:
    """Keep dated events with a value and a key within ``bounds``, both ends included.

    A row without a value, such as a closing row may be, moves the watermark and is no event.
    """
    known = F.col(value).isNotNull()
    return event_time_filter(df, known if bounds is None else known & F.col(key).between(*bounds), ts)


def windowed_stats(
    df: DataFrame,
    days: int,
    bounds: tuple[int, int] | None = VAULT_RANGE,
    key: str = "vault_id",
    ts: str = "ts",
    value: str = TEMPERATURE,
    offset_days: int = 0,
) -> DataFrame:
    """Count, mean and population standard deviation per window and key.

    Batch and streaming. Each task sends one partial row per window and key, however many events
    a key has. The deviation of a single event is 0.0.
    """
    grouped = in_range(df, bounds, key, ts, value).groupBy(window_key(df, ts, days, offset_days).alias("w"), key)
    stats = grouped.agg(
        F.count(value).cast("int").alias("count"),
        F.avg(value).alias("mean_s194"),
        F.stddev_pop(value).alias("stddev_s194"),
    )
    return stats.select(key_start(df, "w").alias("ts"), key, "count", "mean_s194", "stddev_s194")


def stats_of_windows(
    df: DataFrame,
    windows: dict[str, int],
    bounds: tuple[int, int] | None = VAULT_RANGE,
    key: str = "vault_id",
    ts: str = "ts",
    value: str = TEMPERATURE,
) -> DataFrame:
    """As :func:`windowed_stats` for several windows (name: days) at once, named in ``window_name``.

    Batch and streaming. One read and one aggregate: a task sends one partial row per window and key.
    """
    placed = in_windows(in_range(df, bounds, key, ts, value).select(ts, key, value), ts, windows)
    stats = placed.groupBy("window_name", "w", key).agg(
        F.count(value).cast("int").alias("count"),
        F.avg(value).alias("mean_s194"),
        F.stddev_pop(value).alias("stddev_s194"),
    )
    return stats.select("window_name", start_ms("w").alias("ts"), key, "count", "mean_s194", "stddev_s194")


def windowed_variances(
    df: DataFrame,
    days: int,
    bounds: tuple[int, int] | None = VAULT_RANGE,
    key: str = "vault_id",
    ts: str = "ts",
    value: str = TEMPERATURE,
) -> DataFrame:
    """Population and sample variance per window and key; both NaN for fewer than two events."""
    nan = F.lit(float("nan"))
    n = F.count(value)
    grouped = in_range(df, bounds, key, ts, value).groupBy(window_key(df, ts, days).alias("w"), key)
    return grouped.agg(
        n.cast("int").alias("count"),
        F.avg(value).alias("mean_s194"),
        F.when(n < 2, nan).otherwise(F.var_pop(value)).alias("variance"),
        F.when(n < 2, nan).otherwise(F.var_samp(value)).alias("sample_variance"),
    ).select(key_start(df, "w").alias("ts"), key, "count", "mean_s194", "variance", "sample_variance")


def daily_moments(
    df: DataFrame,
    bounds: tuple[int, int] | None = VAULT_RANGE,
    key: str = "vault_id",
    ts: str = "ts",
    value: str = TEMPERATURE,
) -> DataFrame:
    """(count, mean, m2) per day and key of a table: all that any wider window needs."""
    grouped = in_range(df, bounds, key, ts, value).groupBy(grid_start(ts, 1).alias("w"), key)
    return grouped.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.regr_sxx(value, value).alias("m2"),
    ).select(F.timestamp_millis("w").alias("day"), key, "count", "mean", "m2")


def _beside(rows: DataFrame, groups: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Each row with the other columns of its group; null keys are a group."""
    groups = groups.withColumnsRenamed({key: f"_{key}" for key in keys})
    return rows.join(groups, [rows[key].eqNullSafe(groups[f"_{key}"]) for key in keys]).drop(*[f"_{key}" for key in keys])


def merge_moments(partials: DataFrame, *keys: str) -> DataFrame:
    """Merge any number of (count, mean, m2) rows per key; equal to the last bit in any order and partitioning.

    All sums are error-free: terms are cut on a grid that the group's extremes set, and summed as integers. The mean
    comes first and the squares are summed around it, so no digits are lost where means are large beside their
    spread. Every step combines in the tasks before the shuffle: a hot key costs one row per task and step.
    Null keys are a group; rows without a count add nothing. Where a mean or m2 is not finite, both results are NaN.
    """
    if not keys:
        raise ValueError("name the keys to merge by")
    rows = partials.filter(F.col("count") > 0).select(*keys, "count", "mean", "m2")
    finite = F.abs(F.col("mean")) + F.abs(F.col("m2")) < float("inf")
    extremes = rows.groupBy(*keys).agg(
        F.sum("count").alias("_n"),
        F.max("count").alias("_most"),
        F.min("mean").alias("_low"),
        F.max("mean").alias("_high"),
        F.max("m2").alias("_m2"),
        F.bool_and(finite & ~F.isnan("mean") & ~F.isnan("m2")).alias("_sound"),
    )
    reach = F.col("_most") * (F.col("_high") - F.col("_low"))
    extremes = extremes.withColumn("_unit", exact_unit(reach))
    above = exact_sum(F.col("count") * (F.col("mean") - F.col("_low")), F.first("_unit"), F.col("_unit"))
    named = _beside(rows, extremes, keys)
    fixed = [F.first(c).alias(c) for c in ("_n", "_low", "_high", "_most", "_m2", "_sound")]
    centers = named.groupBy(*keys).agg(*fixed, above.alias("_above"))
    centers = centers.select(
        *keys,
        "_n",
        "_sound",
        (F.col("_low") + F.col("_above") / F.col("_n")).alias("_center"),
        exact_unit(F.col("_m2") + F.col("_most") * (F.col("_high") - F.col("_low")) * (F.col("_high") - F.col("_low"))).alias("_unit"),
    )
    off = F.col("mean") - F.col("_center")
    squares = exact_sum(F.col("m2") + F.col("count") * off * off, F.first("_unit"), F.col("_unit"))
    merged = _beside(rows, centers, keys).groupBy(*keys).agg(
        F.first("_n").alias("count"), F.first("_center").alias("mean"), squares.alias("m2"), F.first("_sound").alias("_sound")
    )
    nan = F.lit(float("nan"))
    return merged.select(*keys, "count", *[F.when(F.col("_sound"), F.col(c)).otherwise(nan).alias(c) for c in ("mean", "m2")])


def rollup_stats(daily: DataFrame, days: int, key: str = "vault_id", offset_days: int = 0) -> DataFrame:
    """The result of :func:`windowed_stats` from daily moments. Days nest in every window of whole days.

    A group has one row per day, so its mean is taken over the group first and the squares are
    summed around it, which loses no digits. Both steps use one shuffle.
    """
    group = Window.partitionBy("w", key)
    center = F.sum(F.col("count") * F.col("mean")).over(group) / F.sum("count").over(group)
    placed = daily.filter(F.col("count") > 0).withColumn("w", grid_start("day", days, offset_days)).withColumn("center", center)
    off = F.col("mean") - F.col("center")
    merged = placed.groupBy("w", key).agg(
        F.sum("count").alias("count"),
        F.max("center").alias("mean"),
        F.sum(F.col("m2") + F.col("count") * off * off).alias("m2"),
    )
    return merged.select(
        F.col("w").alias("ts"),
        key,
        F.col("count").cast("int").alias("count"),
        F.col("mean").alias("mean_s194"),
        F.sqrt(F.col("m2") / F.col("count")).alias("stddev_s194"),
    )
