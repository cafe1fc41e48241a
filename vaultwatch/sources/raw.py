"""Raw CSV rows to clean events, with the rows that do not qualify set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwatch.functions.eventtime import parse_time, print_time
from vaultwatch.functions.telemetry import as_float, as_int, is_blank
from vaultwatch.schemas import CSV_OPTIONS, EVENT_SCHEMA, RAW_MIN_WIDTH, RAW_POSITIONS
from vaultwatch.sources.topics import arrival, stream_arrival

EVENT_FIELDS = EVENT_SCHEMA.fieldNames()

EVENT, NO_TEMPERATURE, REJECT = "event", "no_temperature", "reject"


def raw_schema(width: int = RAW_MIN_WIDTH) -> T.StructType:
    """Every cell as text, named by position."""
    if width < RAW_MIN_WIDTH:
        raise ValueError(f"a raw row has at least {RAW_MIN_WIDTH} columns")
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def read_raw(spark: SparkSession, path: str, width: int = RAW_MIN_WIDTH, multi_line: bool = False) -> DataFrame:
    """Scan headered CSV, with ``seq``, the place of each row. The parser reads only the cells that a plan uses.

    Files are split over tasks at line breaks. Where quoted cells may hold line breaks, ``multi_line`` reads each file
    in one task instead.
    """
    reader = spark.read.schema(raw_schema(width)).options(header=True, multiLine=multi_line, **CSV_OPTIONS)
    return reader.csv(path).withColumn("seq", arrival())


def stream_raw(spark: SparkSession, path: str, width: int = RAW_MIN_WIDTH, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(raw_schema(width)).options(header=True, **CSV_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path).withColumn("seq", stream_arrival())


def parse_raw(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed event fields, ``ts``, ``status`` and, for rejects, the ``reason``.

    ``status`` is ``event``, ``no_temperature`` (a sound row that is not published) or ``reject``.
    A row too short has nulls at the missing positions and is judged by them.
    """
    cell = {name: F.col(f"c{position}") for position, name in RAW_POSITIONS.items()}
    typed = {
        "date": parse_time(cell["date"]),
        "failure": as_int(cell["failure"]),
        "vault_id": as_int(cell["vault_id"]),
        "s9_power_on_hours": as_float(cell["s9_power_on_hours"]),
        "s194_temperature_celsius": as_float(cell["s194_temperature_celsius"]),
    }
    # Through ``inline`` each cell is parsed once; a filter on ``status`` would otherwise be moved
    # below the projection and parse all of them again.
    once = F.inline(F.array(F.struct(*[c.alias(f"_{name}") for name, c in typed.items()])))
    value = {name: F.col(f"_{name}") for name in typed}

    def unreadable(name: str) -> Column:
        return ~is_blank(cell[name]) & value[name].isNull()

    reason = (
        F.when(value["date"].isNull(), "date")
        .when(value["failure"].isNull(), "failure")
        .when(value["vault_id"].isNull(), "vault_id")
        .when(unreadable("s9_power_on_hours"), "s9_power_on_hours")
        .when(unreadable("s194_temperature_celsius"), "s194_temperature_celsius")
    )
    keep = tuple(keep) + (("seq",) if "seq" in raw.columns and "seq" not in keep else ())
    no_temperature = value["s194_temperature_celsius"].isNull()
    status = F.when(reason.isNotNull(), REJECT).when(no_temperature, NO_TEMPERATURE).otherwise(EVENT)
    return raw.select("*", once).select(
        cell["date"].alias("date"),
        F.coalesce(cell["serial_number"], F.lit("")).alias("serial_number"),
        F.coalesce(cell["model"], F.lit("")).alias("model"),
        (value["failure"] != 0).alias("failure"),
        value["vault_id"].alias("vault_id"),
        value["s9_power_on_hours"].alias("s9_power_on_hours"),
        value["s194_temperature_celsius"].alias("s194_temperature_celsius"),
        value["date"].alias("ts"),
        status.alias("status"),
        reason.alias("reason"),
        *keep,
    )


def clean_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == EVENT).drop("status", "reason")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == REJECT).drop("status")


def landing(raw: DataFrame) -> DataFrame:
    """Event fields for sound rows, raw cells and reason for rejects, and what to part them by: ``status``, the
    day, and whether the drive has failed."""
    cells = [c for c in raw.columns if c != "seq"]
    parsed = parse_raw(raw, keep=tuple(cells))
    sound, rejected = F.col("status") != REJECT, F.col("status") == REJECT
    return parsed.select(
        *[F.when(sound, F.col(name)).alias(name) for name in EVENT_FIELDS if name != "failure"],
        F.when(sound, F.col("ts")).alias("ts"),
        *[c for c in parsed.columns if c == "seq"],
        F.col("reason"),
        *[F.when(rejected, F.col(name)).alias(name) for name in cells],
        "status",
        F.when(sound, F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.when(sound, F.col("failure")).alias("failure"),
    )


def land(raw: DataFrame, path: str) -> None:
    """One pass over the CSV into Parquet, parted by status, day and failure flag.

    :func:`landed` reads the events; ``{path}/status=reject`` holds the raw cells of each rejected row with the reason.
    """
    landing(raw).write.mode("overwrite").partitionBy("status", "day", "failure").parquet(path)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed events with ``ts`` and ``seq``. Filters on day and failure leave out whole folders."""
    table = spark.read.parquet(path)
    types = {name: EVENT_SCHEMA[name].dataType for name in EVENT_FIELDS}
    fields = [F.col(name).cast(kind).alias(name) for name, kind in types.items()]
    return table.filter(F.col("status") == EVENT).select(*fields, "ts", "seq", "day")


def closing_event(parsed: DataFrame, seq: str, days: int = 7) -> DataFrame:
    """The row that ends a replay: the last row read, dated ``days`` after the last sound row.

    It keeps a missing temperature, and its only work is to move the watermark past open windows.
    One row per task reaches the final step.
    """
    last_read = F.max_by(F.struct(*EVENT_FIELDS), F.col(seq)).alias("row")
    last_ts = F.max_by(F.when(F.col("status") != REJECT, F.col("ts")), F.when(F.col("status") != REJECT, F.col(seq)))
    ends = parsed.agg(last_read, last_ts.alias("ts")).withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {days} DAYS"))
    return ends.filter(F.col("ts").isNotNull()).select(
        print_time("ts").alias("date"), *[F.col(f"row.{name}").alias(name) for name in EVENT_FIELDS[1:]]
    )
