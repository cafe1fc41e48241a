"""Declared schemas: nothing in the package infers a type."""

from __future__ import annotations

from pyspark.sql import types as T

# Every CSV reader and writer: a quote inside a quoted cell is doubled, as other CSV tools do it.
CSV_OPTIONS = {"quote": '"', "escape": '"'}

# Position in the raw CSV row -> field of the event.
RAW_POSITIONS = {
    0: "date",
    1: "serial_number",
    2: "model",
    3: "failure",
    4: "vault_id",
    12: "s9_power_on_hours",
    25: "s194_temperature_celsius",
}
RAW_MIN_WIDTH = max(RAW_POSITIONS) + 1

# Fields of an event, in their order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("serial_number", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("failure", T.BooleanType()),
        T.StructField("vault_id", T.IntegerType()),
        T.StructField("s9_power_on_hours", T.FloatType()),
        T.StructField("s194_temperature_celsius", T.FloatType()),
    ]
)

# Fields of Query 1's result.
TEMPERATURE_RESULT = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("vault_id", T.IntegerType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("mean_s194", T.FloatType()),
        T.StructField("stddev_s194", T.FloatType()),
    ]
)

RANKING_SLOTS = 10


def ranking_result(slots: int = RANKING_SLOTS) -> T.StructType:
    """Fixed values, fields of Query 2's result: ``ts`` and then (vault, failures, disks) for each slot; unused slots are null."""
    schema = T.StructType([T.StructField("ts", T.LongType())])
    for slot in range(1, slots + 1):
        schema = (
            schema.add(f"vault_id{slot}", T.IntegerType())
            .add(f"failures{slot}", T.IntegerType())
            .add(f"failed_disks{slot}", T.StringType())
        )
    return schema


RANKING_RESULT = ranking_result()

# Window name -> length in days. "all" is a fixed 23-day grid, not one window over everything.
WINDOW_DAYS = {"1d": 1, "3d": 3, "all": 23}

# Topic names and, from them, the names of the result files.
QUERY_RESULTS = {"query1": TEMPERATURE_RESULT, "query2": RANKING_RESULT}
EVENT_TOPIC = "hdd_events"


def result_topic(query: str, window: str) -> str:
    if query not in QUERY_RESULTS or window not in WINDOW_DAYS:
        raise ValueError(f"no result topic for query {query!r} and window {window!r}")
    return f"{query}_{window}_results"


RESULT_TOPICS = {
    result_topic(query, window): schema
    for query, schema in QUERY_RESULTS.items()
    for window in WINDOW_DAYS
}


def windows_for(choice: str | list[str] | tuple[str, ...]) -> list[str]:
    """Expand a window choice (``1d``, ``3d``, ``all``, ``all_three`` or a list) into window names."""
    names = list(WINDOW_DAYS) if choice == "all_three" else [choice] if isinstance(choice, str) else list(choice)
    unknown = [name for name in names if name not in WINDOW_DAYS]
    if unknown or not names:
        raise ValueError(f"unknown window choice {choice!r}; use one of {[*WINDOW_DAYS, 'all_three']}")
    return names
