import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from helpers import event, events, frame
from vaultwatch.plans.batch import query1, query2, result_rows, run_batch
from vaultwatch.schemas import EVENT_SCHEMA, RESULT_TOPICS, result_topic, windows_for
from vaultwatch.sources import results, topics
from vaultwatch.streaming import jobs

ROWS = [event("04-02", f"s{i}", i % 2 == 0, 1000 + i % 3, 20.0 + i) for i in range(9)]


def test_topics_and_windows():
    assert list(RESULT_TOPICS) == [f"query{q}_{w}_results" for q in (1, 2) for w in ("1d", "3d", "all")]
    assert windows_for("all_three") == ["1d", "3d", "all"] and windows_for("3d") == ["3d"]
    for bad in ("2d", [], ["1d", "x"]):
        with pytest.raises(ValueError):
            windows_for(bad)
    with pytest.raises(ValueError):
        result_topic("query3", "1d")


@pytest.mark.parametrize("query", ["query1", "query2"])
def test_batch_run_writes_each_topic(spark, tmp_path, query):
    df, out = events(spark, ROWS), str(tmp_path)
    assert run_batch(query, "all_three", df, out) == [f"{query}_{w}_results" for w in ("1d", "3d", "all")]
    single = {"query1": query1, "query2": query2}[query]
    for window in ("1d", "3d", "all"):
        got = results.read_result(spark, out, f"{query}_{window}_results").collect()
        assert sorted(map(str, got)) == sorted(map(str, result_rows(query, single(df, window)).collect()))


def test_a_run_replaces_only_its_own_files(spark, tmp_path):
    df, out = events(spark, ROWS), str(tmp_path)
    run_batch("query1", "all_three", df, out)
    run_batch("query1", "1d", df.filter("vault_id = 1000"), out)
    count = lambda window: results.read_result(spark, out, f"query1_{window}_results").count()
    assert (count("1d"), count("3d"), count("all")) == (1, 3, 3)


def test_nulls_are_empty_cells(spark, tmp_path):
    run_batch("query2", "1d", events(spark, ROWS), str(tmp_path))
    header, row = [r.value for r in spark.read.text(f"{tmp_path}/query2_1d_results.csv").collect()]
    assert header.startswith("ts,vault_id1,failures1,failed_disks1,") and header.endswith("failed_disks10")
    assert row.endswith("," * 21) and '"' in row


def test_unknown_fields_and_topics_are_errors(spark, tmp_path):
    df = query1(events(spark, ROWS), "1d").withColumn("extra", F.lit(1))
    with pytest.raises(ValueError):
        results.write_result(df, str(tmp_path), "query1_1d_results")
    with pytest.raises(ValueError):
        results.result_path(str(tmp_path), "other")


def test_records_are_routed_to_the_files_of_their_topics(spark, tmp_path):
    df, home = events(spark, ROWS), str(tmp_path)
    rows = {"query1_1d_results": query1(df, "1d"), "query2_1d_results": query2(df, "1d")}
    for topic, result in rows.items():
        declared = result_rows(topic.split("_")[0], result)
        topics.encode(declared, RESULT_TOPICS[topic]).withColumn("topic", F.lit(topic)).write.mode("append").parquet(f"{home}/records")
    stream = jobs.streaming_session(spark, 2).readStream.schema("value string, topic string").parquet(f"{home}/records")
    for _ in range(2):
        jobs.start_routing(stream, f"{home}/out", list(rows), f"{home}/c", once=True).awaitTermination()
    for topic, result in rows.items():
        want = result_rows(topic.split("_")[0], result).collect()
        assert sorted(map(str, results.read_result(spark, f"{home}/out", topic).collect())) == sorted(map(str, want))


def test_published_events_are_read_back(spark, tmp_path):
    topics.publish(frame(spark, ROWS), f"{tmp_path}/topic")
    back = spark.read.schema(EVENT_SCHEMA).json(f"{tmp_path}/topic")
    assert sorted(map(str, back.collect())) == sorted(map(str, frame(spark, ROWS).drop("seq").collect()))


ODD = ['q"x', "a, b", "back\\", "\\\"both\\", "plain"]


def test_odd_labels_are_read_back_and_by_other_readers(spark, tmp_path):
    rows = [event("04-02", serial, True) for serial in ODD]
    run_batch("query2", "1d", events(spark, rows), str(tmp_path))
    want = ", ".join(f"M,{serial}" for serial in ODD)
    assert results.read_result(spark, str(tmp_path), "query2_1d_results").first().failed_disks1 == want
    (path,) = glob.glob(f"{tmp_path}/query2_1d_results.csv/part-*")
    with open(path, newline="") as lines:
        header, row = csv.reader(lines)
    assert row[header.index("failed_disks1")] == want
    record = topics.encode(result_rows("query2", query2(events(spark, rows), "1d")), RESULT_TOPICS["query2_1d_results"])
    results.route_results(record.withColumn("topic", F.lit("query2_1d_results")), 3, f"{tmp_path}/routed", ["query2_1d_results"])
    assert results.read_result(spark, f"{tmp_path}/routed", "query2_1d_results").first().failed_disks1 == want


@pytest.mark.parametrize("topic,value", [("other", "{}"), (None, "{}"), ("query1_1d_results", '{"ts": 1, "extra": 2}'), ("query1_1d_results", "{")])
def test_what_no_file_is_for_ends_the_batch(spark, tmp_path, topic, value):
    good = '{"ts": 1, "vault_id": 2, "count": 3, "mean_s194": 1.0, "stddev_s194": null}'
    batch = spark.createDataFrame([("query1_1d_results", good), (topic, value)], "topic string, value string")
    with pytest.raises(Exception):
        results.route_results(batch, 0, str(tmp_path), ["query1_1d_results", "query2_1d_results"])
    assert results.read_result(spark, str(tmp_path), "query1_1d_results").count() == 0
    sound = spark.createDataFrame([("query1_1d_results", good)], batch.schema)
    results.route_results(sound, 0, str(tmp_path), ["query1_1d_results", "query2_1d_results"])
    assert results.read_result(spark, str(tmp_path), "query1_1d_results").count() == 1
    assert os.listdir(tmp_path) == ["query1_1d_results.csv"]
