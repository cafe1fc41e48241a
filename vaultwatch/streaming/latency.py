"""How long events wait until the windows they count in are emitted."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vaultwatch.functions.eventtime import event_time_filter, in_windows, start_ms
from vaultwatch.operators import quantiles
from vaultwatch.sources.results import existing
from vaultwatch.streaming.jobs import start_windows

WINDOW = ["window_name", "ts"]
SKETCH = T.StructType([T.StructField("window_name", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("ts", "bucket", "n")]])
PERMILLE = {"p50_ms": 500, "p99_ms": 990}


def arrivals(df: DataFrame, windows: dict[str, int], ts: str = "ts", arrived: Column | None = None, grain_ms: int = 1000) -> DataFrame:
    """Per window (name: days) how many of its events arrived when: (window_name, ts, closed_ms, arrived_ms, n).

    An event arrives with its batch, or at ``arrived``, to the grain. The state holds a row per open window and grain
    with arrivals, however many events there are. Events without a time count in no window.
    """
    at = F.unix_millis(F.current_timestamp() if arrived is None else arrived)
    dated = event_time_filter(df, F.lit(True), ts).select(ts, (at - F.pmod(at, F.lit(grain_ms))).alias("arrived_ms"))
    counted = in_windows(dated, ts, windows).groupBy("window_name", "w", "arrived_ms").agg(F.count("*").alias("n"))
    return counted.select("window_name", start_ms("w").alias("ts"), F.unix_millis("w.end").alias("closed_ms"), "arrived_ms", "n")


def start_latency(rows: DataFrame, path: str, checkpoint: str, emitted: Column | None = None, once: bool = False) -> StreamingQuery:
    """Log a sketch of the waits of each window that closes, from :func:`arrivals`.

    A window is emitted when its batch is written, or at ``emitted`` (milliseconds). A batch owns a folder and
    replaces it when it is run again, so no wait counts twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.lit(int(time.time() * 1000)) if emitted is None else emitted
        waits = batch.withColumn("wait", now - F.col("arrived_ms"))
        quantiles.sketch(waits, WINDOW, "wait", weight="n").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return start_windows(rows, write, checkpoint, once)


def waits(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`start_latency` has logged so far, a sketch per window."""
    logged = existing(lambda: spark.read.schema(SKETCH).parquet(path), spark, SKETCH)
    return quantiles.merge([logged.select(*SKETCH.fieldNames())], WINDOW)


def latency(spark: SparkSession, path: str, permille: dict[str, int] = PERMILLE, by: tuple[str, ...] = tuple(WINDOW)) -> DataFrame:
    """Events and quantiles of their waits in milliseconds, per window or, by ``window_name`` alone, of all of a length."""
    return quantiles.quantiles(quantiles.merge([waits(spark, path)], list(by)), list(by), permille)
