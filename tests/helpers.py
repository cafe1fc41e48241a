"""Hand-made drive events."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import types as T

from vaultwatch.plans.batch import prepare
from vaultwatch.schemas import EVENT_SCHEMA

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def event(day, serial="S", failure=False, vault=1000, temp=20.0, time="00:00:00.000000"):
    """An event of model M on a day of 2023, given as ``MM-DD``."""
    return (f"2023-{day}T{time}", serial, "M", failure, vault, None, temp)


def frame(spark, rows):
    """The rows with their order as arrival."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("seq", T.LongType())])
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema)


def events(spark, rows):
    return prepare(frame(spark, rows))


def ms(day):
    month, dom = map(int, day.split("-"))
    return int((datetime(2023, month, dom, tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(milliseconds=1))


def tuples(df, *columns):
    return sorted(tuple(row) for row in (df.select(*columns) if columns else df).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
