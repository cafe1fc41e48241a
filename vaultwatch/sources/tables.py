"""Parquet tables seen as drive telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The table as a stream of one pass. The pattern matches a single file as well as a folder of files."""
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def as_telemetry(events: DataFrame) -> DataFrame:
    """The ``events`` table with the roles of drive telemetry.

    Users stand for vaults, ``error`` events for failures, the event id for the serial number.
    Rows without a temperature are left out, as the ingest does it. The column expressions are
    plain, so filters on the new names reach the Parquet scan under the old ones.
    """
    return events.filter(F.col("value").isNotNull()).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("vault_id"),
        F.col("value").alias("s194_temperature_celsius"),
        (F.col("event_type") == "error").alias("failure"),
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("disk"),
    )
