"""What a stream's batches are dealt to: files of the topic, partitions of state, files of the log."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vaultwatch.schemas import WINDOW_DAYS
from vaultwatch.sources import topics
from vaultwatch.streaming import jobs

SF = "/root/testdata/sf0.001"


def wide(spark, partitions):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    return session


def test_state_does_not_widen_with_the_input(spark, tmp_path):
    """Shuffle partitions are set by the size of the input; state by the cores, so that a batch's fixed work stays."""
    topic = f"{tmp_path}/topic"
    files = entry._topic(spark, SF, topic)
    cores = spark.sparkContext.defaultParallelism
    for partitions in (1, 50 * cores):
        session = entry._event_stream(wide(spark, partitions), topic, files).sparkSession
        assert int(session.conf.get("spark.sql.shuffle.partitions")) == min(partitions, 2 * cores)


@pytest.mark.parametrize("rows,files", [(40, 1), (200, 1), (1000, 5)])
def test_batches_of_larger_topics_have_more_files(spark, tmp_path, rows, files):
    events = spark.range(rows).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").alias("seq"))
    topic = f"{tmp_path}/topic"
    assert topics.publish_in_order(events.repartition(3), topic, 4, rows_per_task=50) == files
    read = spark.read.parquet(topic)
    assert read.count() == read.distinct().count() == rows
    spans = read.groupBy("_metadata.file_modification_time").agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("*").alias("n"))
    spans = spans.orderBy("file_modification_time").collect()
    assert all(a.high < b.low for a, b in zip(spans, spans[1:])) and 4 * (files - 1) < len(spans) <= 4 * files


def test_best_days_are_logged_in_one_file_of_a_task(spark, tmp_path):
    session = wide(spark, 2)
    files = entry._topic(session, SF, f"{tmp_path}/topic")
    rows = jobs.ranking_stream(entry._event_stream(session, f"{tmp_path}/topic", files), WINDOW_DAYS)
    written = []
    jobs.start_rankings(rows, f"{tmp_path}/log", lambda df, i: written.append(df.count()), f"{tmp_path}/c", once=True).awaitTermination()
    days = {p.name for p in Path(tmp_path, "log", "kind=report").iterdir()}
    assert len(days) > 10 and sum(written) > 10
    for batch in {p.name for p in Path(tmp_path, "log", "kind=closed").glob("*/batch=*")}:
        assert len(list(Path(tmp_path, "log", "kind=closed").glob(f"*/{batch}/part-*"))) <= 2
