"""Continuous queries: one streaming query for all chosen windows, each emitted once when it closes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from vaultwatch.functions.eventtime import monotonous, pin_utc
from vaultwatch.operators import moments, ranking
from vaultwatch.plans.batch import prepare, result_rows
from vaultwatch.schemas import CSV_OPTIONS, QUERY_RESULTS, WINDOW_DAYS, result_topic, windows_for
from vaultwatch.sources.raw import landing
from vaultwatch.sources.results import found_at, result_path, route_results
from vaultwatch.sources.topics import encode, kafka_writer_options

KAFKA = "kafka"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_partitions(spark: SparkSession) -> int:
    """Two for each of the cluster's cores, the session's shuffle partitions at most.

    A partition of state is opened and committed in every batch, whatever it holds; so where shuffle partitions grow
    with the input, as many of state would make each batch of small counts wait for hundreds of them.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application with state settings of its own.

    State lives in RocksDB, off the heap, with change logs instead of full snapshots per batch. The
    number of state partitions is fixed for a checkpoint's life: choose it for the cluster the query
    grows into. Without a choice it is the session's shuffle partitions.
    """
    session = spark.newSession()
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return pin_utc(session)


def temperature_stream(events: DataFrame, days: int, bounds: tuple[int, int] | None = moments.VAULT_RANGE, lateness: str = "0 seconds") -> DataFrame:
    """Query 1 on a stream. The state holds one accumulator per open window and vault."""
    return moments.windowed_stats(monotonous(prepare(events), lateness=lateness), days, bounds)


def temperature_windows_stream(
    events: DataFrame, windows: dict[str, int], bounds: tuple[int, int] | None = moments.VAULT_RANGE, lateness: str = "0 seconds"
) -> DataFrame:
    """Query 1 for several windows (name: days), named in ``window_name``, from one read into one state."""
    return moments.stats_of_windows(monotonous(prepare(events), lateness=lateness), windows, bounds)


REPORT, CLOSED = "report", "closed"
DAY_TEXT = "yyyy-MM-dd"


def ranking_stream(events: DataFrame, windows: dict[str, int], lateness: str = "0 seconds") -> DataFrame:
    """Query 2 for several windows (name: days) up to the ranking: rows of two kinds for :func:`start_rankings`.

    ``closed``: the best days of windows that close, whose state is counts alone. ``report``: the failure reports of
    the batch, which go to a log by day (``day_text``); a window's lists are read from there, for its winners only.
    """
    prepared = prepare(events)
    closed = ranking.best_days_counted(monotonous(prepared, lateness=lateness), windows).withColumn("kind", F.lit(CLOSED))
    reports = ranking.counted_reports(prepared).withColumn("kind", F.lit(REPORT))
    day_text = F.when(F.col("kind") == REPORT, F.date_format("day", DAY_TEXT))
    return closed.unionByName(reports, allowMissingColumns=True).withColumn("day_text", day_text)


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, path: str | None = None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def start_append(rows: DataFrame, path: str | None, checkpoint: str, fmt: str = "parquet", once: bool = False, **options) -> StreamingQuery:
    """Append rows, for windowed results those of closed windows. File sinks take each row exactly once."""
    return _start(rows.writeStream.outputMode("append").format(fmt).options(**options), checkpoint, once, path)


def start_landing(raw_rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Ingest raw CSV as it arrives, as :func:`vaultwatch.sources.raw.land` does; :func:`raw.landed` reads it.

    A batch owns a folder and replaces it when it is run again. Rows are numbered there, as a stream cannot.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("seq", F.col("seq").withField("row", F.monotonically_increasing_id()))
        landing(placed).write.mode("overwrite").partitionBy("status", "day", "failure").parquet(f"{path}/batch={batch_id}")

    return _start(raw_rows.writeStream.foreachBatch(write), checkpoint, once)


def start_windows(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hand the rows of closed windows, whatever their ``window_name``, to ``write`` batch by batch.

    ``write`` gets the batch's number too and should replace what it has written under it, as a batch may be run
    again. It should read the rows once or keep them, as each read computes the batch anew.
    """
    return _start(rows.writeStream.outputMode("append").foreachBatch(write), checkpoint, once)


def start_rankings(rows: DataFrame, log: str, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Log the rows of :func:`ranking_stream` and rank each window that closes.

    The log is parted by kind, day and batch; a batch that is run again replaces its own folders. Best days have no day
    there, as they are read by batch, so that each task of the state writes one file however many days there are.
    Ranking runs on the closed windows of the batch, which are whole, cut to ten per window in the tasks. Then the winners' reports are
    read from the folders of their days. ``write`` gets (window_name, ts, vault_id, day, failures, rk, disks). Days
    before the start of the oldest open window are not read again: their folders may be removed.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])
    spark = rows.sparkSession  # a batch's own session plans without adaptive execution

    def read(path: str) -> DataFrame | None:
        return found_at(lambda: spark.read.schema(schema).option("basePath", log).parquet(path))

    def step(batch: DataFrame, batch_id: int) -> None:
        writer = batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("kind", "day_text", "batch").parquet(log)
        closed = read(f"{log}/kind={CLOSED}/day_text=*/batch={batch_id}")
        if closed is None:
            return
        best = closed.select("window_name", "ts", "vault_id", "day", "failures", "until", F.date_format("day", DAY_TEXT).alias("day_text"))
        found = ranking.top_vaults(best, window=("window_name", "ts")).collect()  # ten rows per closed window
        days = ",".join(sorted({r["day_text"] for r in found}))
        reports = read(f"{log}/kind={REPORT}/day_text={{{days}}}").select("vault_id", "day", "seq", "disk", "until")
        winners = F.broadcast(spark.createDataFrame(found, ranking.top_vaults(best).schema).drop("day_text"))
        write(ranking.with_counted_disks(reports, winners), batch_id)

    return _start(rows.writeStream.outputMode("append").foreachBatch(step), checkpoint, once)


def start_routing(records: DataFrame, out_dir: str, topics: list[str], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write (topic, value) records to one set of CSV files per topic."""
    writer = records.writeStream.foreachBatch(lambda batch, i: route_results(batch, i, out_dir, topics))
    return _start(writer, checkpoint, once)


def window_writer(query: str, windows: list[str], out_dir: str | None, kafka: str | None = None) -> Callable[[DataFrame, int], None]:
    """Writes the rows of a batch to CSV files per window, in a folder per batch, or with ``kafka`` (the servers) to a
    topic per window as JSON records."""

    def write(rows: DataFrame, batch_id: int) -> None:
        kept = rows.persist()
        try:
            there = {r["window_name"] for r in kept.select("window_name").distinct().collect()}  # a row per window
            for name in [name for name in windows if name in there]:
                topic = result_topic(query, name)
                chosen = result_rows(query, kept.filter(F.col("window_name") == name).drop("window_name"))
                if kafka:
                    encode(chosen, QUERY_RESULTS[query]).write.format(KAFKA).options(**kafka_writer_options(kafka, topic)).save()
                else:
                    path = f"{result_path(out_dir, topic)}/batch={batch_id}"
                    chosen.write.mode("overwrite").options(header="true", **CSV_OPTIONS).csv(path)
        finally:
            kept.unpersist()

    return write


def run_stream(
    query: str,
    windows: str | list[str],
    events: DataFrame,
    out_dir: str | None,
    checkpoints: str,
    once: bool = False,
    kafka: str | None = None,
    lateness: str = "0 seconds",
) -> list[StreamingQuery]:
    """Start a query for the chosen windows over one event stream: one streaming query, which reads the source once.

    Query 2 looks at it a second time for the failure reports alone. Results go to CSV files below ``out_dir``, or
    with ``kafka`` (the servers) to a topic per window as JSON records. The checkpoint belongs to the choice of
    windows. Query 2's log of failure reports lies beside it. With ``once`` it reads what is there and stops.
    """
    names = windows_for(windows)
    lengths = {name: WINDOW_DAYS[name] for name in names}
    home = f"{checkpoints.rstrip('/')}/{query}_{'_'.join(names)}"
    write = window_writer(query, names, out_dir, kafka)
    if query == "query1":
        return [start_windows(temperature_windows_stream(events, lengths, lateness=lateness), write, home, once)]
    return [start_rankings(ranking_stream(events, lengths, lateness), f"{home}_log", write, home, once)]


def wait(queries: list[StreamingQuery]) -> list[StreamingQuery]:
    for query in queries:
        query.awaitTermination()
    return queries
