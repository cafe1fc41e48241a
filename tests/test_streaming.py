import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import event, events, frame, ms
from vaultwatch.functions.eventtime import closed_only, monotonous
from vaultwatch.plans.batch import prepare, query1, query2, result_rows
from vaultwatch.schemas import EVENT_SCHEMA, RANKING_RESULT, TEMPERATURE_RESULT, WINDOW_DAYS
from vaultwatch.sources import results, topics
from vaultwatch.sources.shared import shared_dir
from vaultwatch.streaming import jobs
from vaultwatch.streaming.progress import METRICS_SCHEMA, recorded


class Topic:
    """A folder of JSON files that arrive one after the other."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, str(path), 0
        os.makedirs(self.path, exist_ok=True)

    def add(self, rows):
        texts = [r.value for r in topics.encode(frame(self.spark, rows), EVENT_SCHEMA).collect()]
        return self.add_text("\n".join(texts))

    def add_text(self, text):
        name = f"{self.path}/{self.files:04d}.json"
        with open(name, "w") as f:
            f.write(text)
        when = time.time() - 10_000 + 10 * self.files
        os.utime(name, (when, when))
        self.files += 1
        return self

    def stream(self, files_per_batch=1):
        session = jobs.streaming_session(self.spark, 2)
        return topics.file_events(session, self.path, files_per_batch)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def run(rows, home, schema=None):
    query = jobs.start_append(rows, f"{home}/out", f"{home}/checkpoint", once=True)
    query.awaitTermination()
    return query


def run_q1(topic, days, home):
    return run(jobs.temperature_stream(topic.stream(), days), home)


def run_q2(spark, topic, windows, home, stream=None, fail=None):
    """All rankings that there are after a run of the stream."""

    def write(rows, batch_id):
        if fail and fail(batch_id):
            raise RuntimeError("lost")
        rows.write.mode("overwrite").parquet(f"{home}/out/part{batch_id}")

    rows = jobs.ranking_stream(stream or topic.stream(), windows)
    jobs.start_rankings(rows, f"{home}/log", write, f"{home}/checkpoint", once=True).awaitTermination()
    found = spark.read.parquet(f"{home}/out/*").collect()
    return sorted((r.window_name, r.ts, r.rk, r.vault_id, r.failures, tuple(r.disks)) for r in found)


def emitted(spark, home):
    return sorted((r.ts, r.vault_id, r["count"]) for r in spark.read.parquet(f"{home}/out").collect())


def test_closing_row_outside_the_filter_closes_windows(spark, topic, tmp_path):
    for day in ("04-01", "04-02"):
        topic.add([event(day)])
    topic.add([event("04-09", vault=5000)])
    run_q1(topic, 1, tmp_path)
    assert emitted(spark, tmp_path) == [(ms("04-01"), 1000, 1), (ms("04-02"), 1000, 1)]


def test_sound_drive_closes_windows_of_failures(spark, topic, tmp_path):
    for day in ("04-01", "04-02"):
        topic.add([event(day, failure=True)])
    topic.add([event("04-09", vault=5000)])
    assert run_q2(spark, topic, {"1d": 1}, tmp_path) == [("1d", ms("04-01"), 1, 1000, 1, ("M,S",)), ("1d", ms("04-02"), 1, 1000, 1, ("M,S",))]


def test_late_row_is_dropped_and_counted(spark, topic, tmp_path):
    for day in ("04-01", "04-02", "04-03"):
        topic.add([event(day)])
    topic.add([event("04-04"), event("04-01", serial="late")])
    stream = topic.stream()
    with recorded(stream.sparkSession) as log:
        run(jobs.temperature_stream(stream, 1), tmp_path)
    assert emitted(spark, tmp_path) == [(ms(day), 1000, 1) for day in ("04-01", "04-02", "04-03")]
    totals = log.metrics().agg(F.sum("rows_dropped").alias("d"), F.sum("input_rows").alias("n")).first()
    assert (totals.d, totals.n) == (1, 5)


def test_last_window_stays_open_without_a_closing_row(spark, topic, tmp_path):
    topic.add([event("04-01")]).add([event("04-02")])
    run_q1(topic, 1, tmp_path)
    assert emitted(spark, tmp_path) == [(ms("04-01"), 1000, 1)]


def test_wide_window_that_ends_after_the_closing_row_is_not_emitted(spark, topic, tmp_path):
    topic.add([event("04-11")]).add([event("04-18")])
    run_q1(topic, 23, tmp_path)
    assert emitted(spark, tmp_path) == []


def test_restart_emits_nothing_twice(spark, topic, tmp_path):
    topic.add([event("04-01")]).add([event("04-02")]).add([event("04-09")])
    run_q1(topic, 1, tmp_path)
    before = emitted(spark, tmp_path)
    run_q1(topic, 1, tmp_path)
    assert emitted(spark, tmp_path) == before and len(before) == 2
    topic.add([event("04-16")])
    run_q1(topic, 1, tmp_path)
    assert emitted(spark, tmp_path) == before + [(ms("04-09"), 1000, 1)]


def test_corrupt_record_ends_the_run(spark, topic, tmp_path):
    topic.add([event("04-01")]).add_text('{"date": ')
    with pytest.raises(Exception, match="(?i)stream_failed"):
        run_q1(topic, 1, tmp_path)


def month(spark):
    """Events of 25 vaults over twelve days, a tenth of them failures, half of these in one vault."""
    rows = []
    for i in range(1200):
        failed = i % 10 == 0
        vault = 1003 if i % 20 == 0 else 1000 + i % 25
        day = f"04-{1 + i // 100:02d}"
        rows.append(event(day, f"{i * 7919 % 1200:05d}", failed, vault, 15.0 + i % 13))
    return rows


@pytest.fixture
def busy(spark, topic):
    rows = month(spark)
    for start in range(0, 1200, 100):
        topic.add(rows[start : start + 100])
    topic.add([event("04-19", failure=True)])
    return topic, rows


@pytest.mark.parametrize("window,days", [("1d", 1), ("3d", 3), ("all", 23)])
def test_streams_equal_batch(spark, tmp_path, window, days):
    rows, path = [*month(spark), event("04-19", failure=True)], str(tmp_path / "topic")
    df = prepare(frame(spark, rows))
    files = topics.publish_in_order(df.drop("disk"), path, 5)
    out, checkpoints = str(tmp_path / "results"), str(tmp_path / "checkpoints")
    for query in ("query1", "query2"):
        stream = topics.parquet_events(jobs.streaming_session(spark, 2), path, df.drop("disk").schema, files)
        jobs.wait(jobs.run_stream(query, window, stream, out, checkpoints, once=True))
    for query, batch in (("query1", query1(df, window)), ("query2", query2(df, window))):
        want = closed_only(result_rows(query, batch), F.lit(ms("04-19")), days).collect()
        got = results.read_result(spark, out, f"{query}_{window}_results").collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and want


def in_any_order(row):
    """The row with its lists sorted, as JSON files do not tell the order of their lines."""
    return str([sorted(v.split(", ")) if isinstance(v, str) else v for v in row])


@pytest.mark.parametrize("query", ["query1", "query2"])
def test_all_windows_from_one_read(spark, busy, tmp_path, query):
    topic, rows = busy
    stream = topic.stream(3)
    with recorded(stream.sparkSession) as log:
        started = jobs.wait(jobs.run_stream(query, "all_three", stream, str(tmp_path / "out"), str(tmp_path / "c"), once=True))
    assert len(started) == 1
    found = log.metrics()
    assert found.schema == METRICS_SCHEMA
    assert found.filter("input_rows > 0").count() == 5
    again = 0 if query == "query1" else 1 + sum(row[3] for row in rows)  # the reports, which the source filters
    assert found.agg(F.sum("input_rows")).first()[0] == len(rows) + 1 + again
    df = events(spark, [*rows, event("04-19", failure=True)])
    for window, days in WINDOW_DAYS.items():
        batch = {"query1": query1, "query2": query2}[query](df, window)
        want = closed_only(result_rows(query, batch), F.lit(ms("04-19")), days).collect()
        got = results.read_result(spark, str(tmp_path / "out"), f"{query}_{window}_results").collect()
        assert sorted(map(in_any_order, got)) == sorted(map(in_any_order, want))
        assert want or window == "all"


def test_late_failures_are_neither_counted_nor_listed(spark, topic, tmp_path):
    topic.add([event("04-01", "b", True), event("04-01", "a", True, vault=1001)])
    topic.add([event("04-01", "a", True), event("04-01", "c", True)])
    topic.add([event("04-02", "d", True), event("04-01", "in time", True)])
    topic.add([event("04-01", "still in time", True), event("04-03", "e", True)])  # the day closes with this batch
    topic.add([event("04-01", "late", True), event("04-03", "f", True)])
    topic.add([event("04-01", "later", True), event("04-02", "late", True), event("04-12")])
    got = run_q2(spark, topic, {"1d": 1, "3d": 3}, tmp_path)
    first, third = ("M,b", "M,a", "M,c", "M,in time", "M,still in time"), ("M,e", "M,f")
    assert got == [
        ("1d", ms("04-01"), 1, 1000, 5, first),
        ("1d", ms("04-01"), 2, 1001, 1, ("M,a",)),
        ("1d", ms("04-02"), 1, 1000, 1, ("M,d",)),
        ("1d", ms("04-03"), 1, 1000, 2, third),
        ("3d", ms("03-30"), 1, 1000, 5, first),
        ("3d", ms("03-30"), 2, 1001, 1, ("M,a",)),
        ("3d", ms("04-02"), 1, 1000, 2, third),
    ]


def test_a_batch_lost_before_its_results_is_run_again(spark, busy, tmp_path):
    topic, rows = busy
    windows = {"3d": 3, "1d": 1}
    want = run_q2(spark, topic, windows, tmp_path / "whole", topic.stream(4))
    with pytest.raises(Exception, match="(?i)stream_failed"):
        run_q2(spark, topic, windows, tmp_path / "lost", topic.stream(4), fail=lambda batch_id: batch_id == 2)
    assert run_q2(spark, topic, windows, tmp_path / "lost", topic.stream(4)) == want and want


@pytest.mark.parametrize("failures", [2, 400])
def test_state_of_rankings_is_counts(spark, topic, tmp_path, failures):
    """As many rows of numbers whatever the failures of a vault."""
    for day in ("04-01", "04-02"):
        topic.add([event(day, f"disk {i}", True, 1000 + v) for v in range(5) for i in range(failures)])
    rows = jobs.ranking_stream(topic.stream(), WINDOW_DAYS)
    jobs.start_rankings(rows, f"{tmp_path}/log", lambda df, i: df.count(), f"{tmp_path}/checkpoint", once=True).awaitTermination()
    sizes = []
    for operator in (0, 1):
        state = topic.stream().sparkSession.read.format("statestore").option("operatorId", operator).load(f"{tmp_path}/checkpoint")
        kind = state.schema["value"].dataType.simpleString()
        assert "array" not in kind and "string" not in kind
        sizes.append(state.count())
    assert sizes[0] == sizes[1] == 5  # one open day; one open wide window, as the others end where the second day begins


def test_files_out_of_time_order_need_a_lateness(spark, topic, tmp_path):
    for day in ("04-05", "04-06", "04-02", "04-20"):
        topic.add([event(day, failure=True)])
    for name, files, lateness in (("one", 1, "0 seconds"), ("one-late", 1, "4 days"), ("all", None, "0 seconds")):
        for query in ("query1", "query2"):
            jobs.wait(jobs.run_stream(query, "1d", topic.stream(files), str(tmp_path / name), str(tmp_path / f"c-{name}"), once=True, lateness=lateness))
        counts = [results.read_result(spark, str(tmp_path / name), f"{query}_1d_results").count() for query in ("query1", "query2")]
        assert counts == ([2, 2] if name == "one" else [3, 3])


@pytest.mark.parametrize("rows_per_file", [5_000_000, 40])
def test_replay_in_order_loses_nothing(spark, tmp_path, rows_per_file):
    """Whatever a batch reads, also where one instant holds a third of the rows."""
    rows = month(spark) + [event("04-06", f"hot {i}", i % 9 == 0, 1004, 21.0) for i in range(600)]
    df = prepare(frame(spark, rows)).repartition(5)
    files = topics.publish_in_order(df.drop("seq", "disk"), f"{tmp_path}/topic", 4, rows_per_file=rows_per_file)
    assert (files > 1) == (rows_per_file == 40)
    topic = spark.read.parquet(f"{tmp_path}/topic")
    assert topic.count() == len(rows)
    spans = topic.groupBy("_metadata.file_name", "_metadata.file_modification_time").agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    spans = spans.orderBy("file_modification_time").collect()
    assert len({s.file_modification_time for s in spans}) == len(spans) >= 4
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))
    want = sorted((r.ts, r.vault_id, r["count"]) for r in query1(df, "1d").collect() if r.ts < ms("04-12"))
    session = jobs.streaming_session(spark, 2)
    for name, batch in (("batches", files), ("all", None), ("other", 3 * files)):
        stream = topics.parquet_events(session, f"{tmp_path}/topic", topic.schema, batch)
        run(jobs.temperature_stream(stream, 1), tmp_path / name)
        assert emitted(spark, tmp_path / name) == want


def test_a_topic_grows_in_order(spark, tmp_path):
    df = prepare(frame(spark, month(spark)))
    early, late = df.filter("date < '2023-04-05'"), df.filter("date >= '2023-04-05'")
    for part in (early, late):
        topics.publish_in_order(part, f"{tmp_path}/topic", 3)
    files = spark.read.parquet(f"{tmp_path}/topic").groupBy("_metadata.file_modification_time").agg(F.max("ts").alias("high"))
    highs = [r.high for r in files.orderBy("file_modification_time").collect()]
    assert highs == sorted(highs) and len(highs) == 6


def test_results_for_kafka_are_json_records_per_window(spark, busy, tmp_path, monkeypatch):
    """The connector is not on the class path: what it would be given is written to folders by topic instead."""
    topic, _ = busy
    monkeypatch.setattr(jobs, "kafka_writer_options", lambda servers, name: {"path": str(tmp_path / f"{servers}-{name}")})
    monkeypatch.setattr(jobs, "KAFKA", "text")
    for query in ("query1", "query2"):
        jobs.wait(jobs.run_stream(query, ["1d", "3d"], topic.stream(None), None, str(tmp_path / "c"), once=True, kafka="broker"))
        for window in ("1d", "3d"):
            schema = results.RESULT_TOPICS[f"{query}_{window}_results"]
            records = topics.decode(spark.read.text(str(tmp_path / f"broker-{query}_{window}_results")), schema)
            assert records.columns == schema.fieldNames() and records.count() > 3


def test_progress_of_many_batches_is_complete(spark, topic, tmp_path):
    for i in range(12):
        topic.add([event(f"04-{1 + i:02d}")])
    stream = topic.stream()
    stream.sparkSession.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    with recorded(stream.sparkSession) as log:
        log._rows_per_file = 5
        query = run(jobs.temperature_stream(stream, 1), tmp_path)
    assert len(query.recentProgress) <= 2
    assert log.metrics().agg(F.sum("input_rows")).first()[0] == 12


def test_watermark_takes_utc_timestamps(spark, topic):
    topic.add([event("04-01")])
    df = monotonous(prepare(topic.stream()))
    assert df.schema["ts"].dataType.typeName() == "timestamp"


def test_state_partitions_are_those_of_the_session(spark):
    assert jobs.streaming_session(spark, 200).conf.get("spark.sql.shuffle.partitions") == "200"
    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", 200)
    assert jobs.streaming_session(wide).conf.get("spark.sql.shuffle.partitions") == "200"


def test_declared_streams(spark, topic):
    topic.add([event("04-01")])
    assert result_rows("query1", jobs.temperature_stream(topic.stream(), 1)).schema.fieldNames() == TEMPERATURE_RESULT.fieldNames()
    assert RANKING_RESULT.fieldNames()[-1] == "failed_disks10"


def test_shared_folder_is_required_on_a_cluster(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{root}/vaultwatch/x-")

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        shared_dir(Cluster, "x")
