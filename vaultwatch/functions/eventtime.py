"""Event time: parsing, windows, and filters that leave the watermark alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000

# One-letter fields take one or two digits, and the fraction one to six, as "%m", "%d", ... "%f" do.
PARSE_FORMAT = "yyyy-M-d'T'H:m:s.SSSSSS"
PRINT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Windows and parsed dates are UTC; NTZ columns are read in the session zone, so pin it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(text: Column | str) -> Column:
    """``2023-04-01T00:00:00.000000`` to a timestamp; null for any other layout."""
    return F.try_to_timestamp(_col(text), F.lit(PARSE_FORMAT))


def print_time(ts: Column | str) -> Column:
    return F.date_format(_col(ts), PRINT_FORMAT)


def tumbling(ts: Column | str, days: int, offset_days: int = 0) -> Column:
    """Half-open tumbling window on a grid that starts at the epoch plus ``offset_days``.

    ``ts`` may be a timestamp or the window column of an earlier aggregate.
    """
    length = f"{days} days"
    return F.window(_col(ts), length, length, f"{offset_days} days") if offset_days else F.window(_col(ts), length)


def grid_start(ts: Column | str, days: int, offset_days: int = 0) -> Column:
    """Start of the :func:`tumbling` window as epoch milliseconds, for batch plans.

    One long as grouping key in place of a pair of timestamps, and one division per row.
    """
    ms = F.unix_millis(_col(ts))
    return ms - F.pmod(ms - F.lit(offset_days * DAY_MS), F.lit(days * DAY_MS))


def window_key(df: DataFrame, ts: str, days: int, offset_days: int = 0) -> Column:
    """Grouping key of a window: the grid's start, or the window itself on streams, whose state it bounds."""
    return tumbling(ts, days, offset_days) if df.isStreaming else grid_start(ts, days, offset_days)


def key_start(df: DataFrame, key: str) -> Column:
    """The start in milliseconds of a column made by :func:`window_key`."""
    return start_ms(key) if df.isStreaming else F.col(key)


def start_ms(window: Column | str) -> Column:
    return F.unix_millis(_col(window)["start"])


def in_windows(df: DataFrame, ts: str, windows: dict[str, int], mark: str | None = None) -> DataFrame:
    """Each row once per window (name: days), with ``window_name`` and ``w``, the :func:`tumbling` window it falls in.

    Grouped by both, windows of several lengths share one read and one state. On streams ``w`` carries the watermark
    of ``mark`` (``ts``, or the window of an earlier aggregate), so each window's state goes when that window ends.
    """
    metadata = df.schema[mark or ts].metadata

    def place(name: str, days: int) -> Column:
        start = grid_start(ts, days)
        window = F.struct(F.timestamp_millis(start).alias("start"), F.timestamp_millis(start + days * DAY_MS).alias("end"))
        return F.struct(F.lit(name).alias("window_name"), window.alias("w"))

    placed = df.withColumn("_place", F.explode(F.array(*[place(name, days) for name, days in windows.items()])))
    kept = [c for c in df.columns if c not in ("window_name", "w")]
    return placed.select(*kept, F.col("_place.window_name").alias("window_name"), F.col("_place.w").alias("w", metadata=metadata))


def with_event_time(df: DataFrame, date: str = "date", ts: str = "ts") -> DataFrame:
    """Event time from the event's own date text. A date that does not parse fails the job."""
    return df.withColumn(ts, F.to_timestamp(F.col(date), PARSE_FORMAT))


def monotonous(df: DataFrame, ts: str = "ts", lateness: str = "0 seconds") -> DataFrame:
    """Watermark at the latest event time seen, less ``lateness``.

    Without an allowance, a row that comes in a later batch than one of a window after its own is dropped; so
    sources in time order need none, and others the longest stretch by which they are out of order.
    """
    return df.withWatermark(ts, lateness)


def event_time_filter(df: DataFrame, predicate: Column, ts: str = "ts") -> DataFrame:
    """Filter dated rows but let every row, kept or not, move the watermark.

    A filter that does not mention the event time is moved below the watermark by the optimizer;
    rows it drops would then no longer close windows. Naming ``ts`` in the predicate prevents that.
    Batch plans take plain conditions, so that they reach the Parquet scan.
    """
    if not df.isStreaming:
        return df.filter(F.col(ts).isNotNull() & predicate)
    return df.filter(F.when(F.col(ts).isNull(), F.lit(False)).otherwise(predicate))


def closed_only(result: DataFrame, latest: Column, days: int, ts: str = "ts") -> DataFrame:
    """Of a batch result keep the windows a stream would have emitted after an event at ``latest`` (epoch ms)."""
    return result.filter(F.col(ts) + F.lit(days * DAY_MS) <= latest)
