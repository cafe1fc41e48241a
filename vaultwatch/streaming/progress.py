"""Rates and durations of streaming queries as rows."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from vaultwatch.sources.results import existing
from vaultwatch.sources.shared import shared_dir

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("trigger_ms", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_bytes", T.LongType()),
        T.StructField("rows_dropped", T.LongType()),
    ]
)


def _row(progress: dict) -> tuple:
    state = progress.get("stateOperators") or []
    return (
        progress.get("name") or progress["id"],
        progress["runId"],
        progress["batchId"],
        progress["numInputRows"],
        progress.get("inputRowsPerSecond"),
        progress.get("processedRowsPerSecond"),
        (progress.get("durationMs") or {}).get("triggerExecution"),
        (progress.get("eventTime") or {}).get("watermark"),
        sum(s["numRowsTotal"] for s in state),
        sum(s["memoryUsedBytes"] for s in state),
        sum(s["numRowsDroppedByWatermark"] for s in state),
    )


class ProgressLog(StreamingQueryListener):
    """Listener that writes the progress of every query of a session to a table in the shared folder.

    Register with ``spark.streams.addListener(log)`` before the queries start. Every batch is kept: rows go out in
    files of ``rows_per_file``, and what is not yet written is held here until then.
    """

    def __init__(self, spark: SparkSession, rows_per_file: int = 1000):
        self._spark, self._rows_per_file = spark, rows_per_file
        self._path = shared_dir(spark, "progress")
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = _row(json.loads(event.progress.json))
        with self._lock:
            self._rows.append(row)
            if len(self._rows) >= self._rows_per_file:
                self._write()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def _write(self) -> None:
        self._spark.createDataFrame(self._rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(self._path)
        self._rows = []

    def metrics(self) -> DataFrame:
        """All batches so far, the latest state of each if its progress came more than once."""
        with self._lock:
            if self._rows:
                self._write()
        rows = existing(lambda: self._spark.read.schema(METRICS_SCHEMA).parquet(self._path), self._spark, METRICS_SCHEMA)
        return rows.dropDuplicates(["query", "run", "batch_id", "input_rows", "trigger_ms"])


@contextmanager
def recorded(spark: SparkSession) -> Iterator[ProgressLog]:
    """A log of the queries that start inside; on leaving, all their events have arrived."""
    log = ProgressLog(spark)
    spark.streams.addListener(log)
    try:
        yield log
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
