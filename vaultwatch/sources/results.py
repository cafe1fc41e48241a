"""Result rows in their declared form, and the files they end in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwatch.schemas import CSV_OPTIONS, RESULT_TOPICS
from vaultwatch.sources.topics import decode


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, in their declared types. An unknown column is an error."""
    unknown = sorted(set(df.columns) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"columns outside the declared result: {unknown}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def result_path(out_dir: str, topic: str) -> str:
    if topic not in RESULT_TOPICS:
        raise ValueError(f"unknown result topic {topic!r}")
    return f"{out_dir.rstrip('/')}/{topic}.csv"


def write_result(df: DataFrame, out_dir: str, topic: str) -> None:
    """Replace one topic's CSV files; the other topics' files stay. Without rows there is a file with the header."""
    rows = declared(df, RESULT_TOPICS[topic])
    rows.write.mode("overwrite").options(header=True, **CSV_OPTIONS).csv(result_path(out_dir, topic))


def checked(records: DataFrame, topics: list[str]) -> DataFrame:
    """(topic, value) records whose topic is among ``topics`` and whose fields are all declared; others end the job."""
    known = F.create_map(*[c for t in topics for c in (F.lit(t), F.array(*[F.lit(n) for n in RESULT_TOPICS[t].fieldNames()]))])
    fields = F.map_keys(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"}))
    unknown_topic = F.raise_error(F.concat(F.lit("record of an unknown result topic: "), F.coalesce("topic", F.lit("null"))))
    extra = F.array_except(fields, known[F.col("topic")])
    unknown_field = F.raise_error(F.concat(F.lit("field outside the declared result: "), F.concat_ws(", ", extra)))
    value = F.when(F.col("topic").isNull() | ~F.col("topic").isin(topics), unknown_topic.cast("string")).when(F.size(extra) > 0, unknown_field.cast("string"))
    return records.select("topic", value.otherwise(F.col("value")).alias("value"))


def route_results(batch: DataFrame, batch_id: int, out_dir: str, topics: list[str]) -> None:
    """Write a batch of (topic, value) records to the files of the topics they name.

    A record of another topic, or with an unknown field, ends the batch before anything is written. The batch is
    read once. It owns a folder per topic that it has records of and replaces it when it is run again, so a restart
    neither loses nor repeats rows.
    """
    records = checked(batch, topics).persist()
    try:
        for (topic, _) in records.groupBy("topic").agg(F.count("value")).collect():  # a row per topic; checks every record
            rows = decode(records.filter(F.col("topic") == topic), RESULT_TOPICS[topic])
            path = f"{result_path(out_dir, topic)}/batch={batch_id}"
            rows.write.mode("overwrite").options(header=True, **CSV_OPTIONS).csv(path)
    finally:
        records.unpersist()


def read_result(spark: SparkSession, out_dir: str, topic: str) -> DataFrame:
    """Read a topic's files back, also those in per-batch folders; without any, a table without rows."""
    reader = spark.read.schema(RESULT_TOPICS[topic]).options(header=True, recursiveFileLookup=True, **CSV_OPTIONS)
    return existing(lambda: reader.csv(result_path(out_dir, topic)), spark, RESULT_TOPICS[topic])


def found_at(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` finds, or nothing where no path of it is there."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def existing(read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    """What ``read`` finds, or no rows where nothing has been written yet."""
    found = found_at(read)
    return spark.createDataFrame([], schema) if found is None else found
