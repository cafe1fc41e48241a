"""

All of them read the whole ``events`` table, seen as drive telemetry: users stand for vaults
(range 0..20 for Query 1), ``error`` events for failures and event ids for serial numbers.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwatch.functions.eventtime import monotonous, pin_utc, print_time, with_event_time
from vaultwatch.functions.telemetry import join_disks
from vaultwatch.operators import moments, pages, ranking, sequence
from vaultwatch.operators.quantiles import BITS
from vaultwatch.plans import batch
from vaultwatch.schemas import EVENT_SCHEMA, RANKING_SLOTS, WINDOW_DAYS
from vaultwatch.sources import raw, tables, topics
from vaultwatch.sources.results import existing
from vaultwatch.sources.shared import settle, shared_dir
from vaultwatch.streaming import jobs, latency
from vaultwatch.streaming.progress import ProgressLog, recorded

USERS = (0, 20)
CLOSING_DAYS = 7
Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(pin_utc(spark), sf_dir, "events", tables.EVENTS_SCHEMA)


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_telemetry(_events(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, by way of nine: the first step takes away the noise of the order of summation,
    so that means which end in an exact half are rounded the same way by every engine."""
    return df.withColumns({c: F.round(F.round(c, 9), 6) for c in columns})


def _stats(df: DataFrame) -> DataFrame:
    return _rounded(df, "mean_s194", "stddev_s194")


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("disks", join_disks(F.col("disks")))


# Query 1


def _q1(window: str) -> Query:
    return lambda spark, d: _stats(batch.query1(_telemetry(spark, d), window, USERS))


def _q1_rollup(window: str) -> Query:
    def run(spark, d):
        daily = moments.daily_moments(_telemetry(spark, d), USERS)
        return _stats(moments.rollup_stats(daily, WINDOW_DAYS[window]))

    return run


def _q1_windows(spark, d):
    """The three windows from one scan."""
    parts = batch.query1_windows(_telemetry(spark, d), "all_three", USERS)
    named = [df.withColumn("window_name", F.lit(name)) for name, df in parts.items()]
    return _stats(named[0].unionByName(named[1]).unionByName(named[2]))


def _q1_moments_daily(spark, d):
    daily = moments.daily_moments(_telemetry(spark, d), USERS)
    return _rounded(daily.select(F.unix_millis("day").alias("ts"), "vault_id", "count", "mean", "m2"), "mean", "m2")


LIFT = 1e8  # far from zero, as sums of squares must not lose the spread; values in quarters stay exact there


def _q1_merge_moments(spark, d):
    """Hourly partials of values far from zero, merged to days."""
    df = _telemetry(spark, d).filter("s194_temperature_celsius IS NOT NULL AND vault_id BETWEEN %d AND %d" % USERS)
    value = F.round(F.col("s194_temperature_celsius") * 4) / 4 + LIFT
    rows = df.select("vault_id", F.date_trunc("hour", "ts").alias("hour"), value.alias("v"))
    hourly = rows.groupBy("vault_id", "hour").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.regr_sxx("v", "v").alias("m2"))
    merged = moments.merge_moments(hourly.withColumn("ts", F.unix_millis(F.date_trunc("day", "hour"))), "ts", "vault_id")
    # in two steps, as _rounded does it; the lift leaves fewer decimals
    return merged.select("ts", "vault_id", "count", F.round(F.round("mean", 6), 4).alias("mean"), F.round(F.round("m2", 4), 1).alias("m2"))


def _q1_variances(spark, d):
    df = moments.windowed_variances(_telemetry(spark, d), 1, USERS)
    return _rounded(df, "mean_s194", "variance", "sample_variance")


# Query 2


def _q2_daily_failures(spark, d):
    df = ranking.daily_failures(_telemetry(spark, d))
    return _as_text(df.select(F.unix_millis("w.start").alias("ts"), "vault_id", "failures", "disks"))


def _q2_best_day(window: str) -> Query:
    def run(spark, d):
        df = _telemetry(spark, d)
        best = settle(ranking.best_day(ranking.daily_counts(df), WINDOW_DAYS[window]), "best-day")
        return _as_text(ranking.with_disks(df, best)).withColumn("day", F.unix_millis("day"))

    return run


def _long(df: DataFrame) -> DataFrame:
    return df.select("ts", "rk", "vault_id", "failures", "disks")


def _q2(window: str) -> Query:
    return lambda spark, d: _long(_as_text(batch.query2(_telemetry(spark, d), window)))


def _q2_wide(window: str) -> Query:
    return lambda spark, d: ranking.widen(batch.query2(_telemetry(spark, d), window))


def _q2_disks(window: str) -> Query:
    """The ranking with a row per failed disk, so that no list is built at all."""

    def run(spark, d):
        df = _telemetry(spark, d)
        winners = settle(ranking.ranked(df, WINDOW_DAYS[window]), "ranking")
        rows = ranking.failed_disks(df, winners)
        return rows.select("ts", "rk", "vault_id", "failures", F.unix_micros("reported").alias("reported_us"), "disk")

    return run


def _q2_windows(spark, d):
    """The three windows from two scans."""
    parts = batch.query2_windows(_telemetry(spark, d), "all_three")
    named = [_long(_as_text(df)).withColumn("window_name", F.lit(name)) for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _q2_merge_rankings(spark, d):
    """Rankings of the first 11 and the last 12 days of each 23-day window, merged on counts; lists come after."""
    days, df = WINDOW_DAYS["all"], _telemetry(spark, d)
    parts = [ranking.ranked(part, days) for part in batch.first_part(df, days, 11)]
    winners = settle(ranking.merge_rankings(*parts), "ranking")
    return _long(_as_text(ranking.with_disks(df, winners)))


PAGE = 3  # disks to a page; small, as the lists of these tables are short


def _pages(df: DataFrame) -> DataFrame:
    return _as_text(df).select("ts", "rk", "vault_id", "failures", "page", "disks")


def _q2_pages(window: str) -> Query:
    return lambda spark, d: _pages(pages.ranked_with_pages(_telemetry(spark, d), WINDOW_DAYS[window], rows_per_page=PAGE))


def _q2_merge_pages(spark, d):
    """Paged rankings of the first 11 and the last 12 days of each 23-day window, merged without opening a list."""
    days = WINDOW_DAYS["all"]
    parts = batch.first_part(_telemetry(spark, d), days, 11)
    return _pages(pages.merge_paged(*[pages.ranked_with_pages(part, days, rows_per_page=PAGE) for part in parts]))


# Ingest and topics


def _raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written out as raw CSV lines and parsed back into cells.

    Values below 5 give a malformed cell, of a kind that depends on the event type.
    """
    events = _events(spark, sf_dir)
    bad = F.col("value") < 5

    def kind(name: str) -> Column:
        return bad & (F.col("event_type") == name)

    ts = F.col("ts").cast("timestamp")
    cells = {i: F.lit("") for i in range(26)} | {
        0: F.when(kind("signup"), F.date_format(ts, "yyyy-MM-dd")).otherwise(print_time(ts)),
        1: F.col("event_id").cast("string"),
        2: F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.col("event_type"), F.lit(', "x"'))),
        3: F.when(kind("purchase"), "x").when(F.col("event_type") == "purchase", "2").when(F.col("event_type") == "error", "1").otherwise("0"),
        4: F.when(kind("click"), F.concat(F.col("user_id").cast("string"), F.lit(".5"))).otherwise(F.col("user_id").cast("string")),
        5: F.col("props"),
        12: F.when(kind("view"), "bad").when(F.col("event_type") == "click", F.col("user_id").cast("string")).otherwise(""),
        25: F.when(kind("error"), "").otherwise(F.col("value").cast("string")),
    }
    lines = events.select(F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in cells.items()]), raw.CSV_OPTIONS).alias("line"))
    return lines.select(F.inline(F.array(F.from_csv("line", raw.raw_schema().toDDL(), raw.CSV_OPTIONS))))


def _ingest_clean(spark, d):
    df = raw.clean_events(raw.parse_raw(_raw_cells(spark, d)))
    return df.select(
        F.unix_micros("ts").alias("ts_us"),
        "serial_number",
        "model",
        "failure",
        "vault_id",
        F.round(F.col("s9_power_on_hours").cast("double"), 2).alias("s9_power_on_hours"),
        F.round(F.col("s194_temperature_celsius").cast("double"), 2).alias("s194_temperature_celsius"),
    )


def _ingest_rejects(spark, d):
    return raw.rejected_rows(raw.parse_raw(_raw_cells(spark, d))).select("serial_number", "reason")


def _json_roundtrip(spark, d):
    """Every event as a topic record and back."""
    df = _telemetry(spark, d)
    events = df.select(
        print_time("ts").alias("date"),
        F.col("disk").alias("serial_number"),
        F.lit("M").alias("model"),
        "failure",
        "vault_id",
        F.lit(None).cast("float").alias("s9_power_on_hours"),
        "s194_temperature_celsius",
    )
    back = topics.decode(topics.encode(events, EVENT_SCHEMA), EVENT_SCHEMA)
    temperature = F.round(F.col("s194_temperature_celsius").cast("double"), 2)
    return back.withColumn("s194_temperature_celsius", temperature)


def _event_gaps(spark, d):
    df = sequence.event_gaps(_telemetry(spark, d).select("seq", "ts"))
    return df.select("seq", F.unix_micros("ts").alias("ts_us"), F.round("gap_seconds", 6).alias("gap_seconds"))


def _closing_row(spark, d):
    row = sequence.closing_row(_telemetry(spark, d), days=CLOSING_DAYS)
    return row.select(print_time("ts").alias("date"), "seq", "vault_id", "s194_temperature_celsius", "failure")


# Streams


BATCHES = 5


def _topic(spark: SparkSession, sf_dir: str, path: str) -> int:
    """The events as a file topic in order of time, with the date as text, and the closing row as the last file.

    The closing row's user is beyond Query 1's range: it only moves the watermark. Returns the files of a batch.
    """
    events = _telemetry(spark, sf_dir)
    closing = sequence.closing_row(events, days=CLOSING_DAYS).withColumns({"vault_id": F.lit(-1).cast("long"), "failure": F.lit(False)})
    files = topics.publish_in_order(_dated(events), path, BATCHES)
    _dated(closing).write.mode("append").parquet(path)
    return files


def _dated(events: DataFrame) -> DataFrame:
    return events.withColumn("date", print_time("ts"))


def _event_stream(spark: SparkSession, path: str, files: int) -> DataFrame:
    """The topic as a stream of several batches. Event time is read from the date text."""
    session = jobs.streaming_session(spark, jobs.state_partitions(spark))
    stream = topics.parquet_events(session, path, spark.read.parquet(path).schema, files)
    return with_event_time(stream.drop("ts"))


def _run(build: Callable[[DataFrame, str], object], spark: SparkSession, home: str, files: int) -> ProgressLog:
    """Go on from the checkpoint over what the topic holds, and then stop; returns the log of the run."""
    events = _event_stream(spark, f"{home}/topic", files)
    with recorded(events.sparkSession) as log:
        build(events, home).awaitTermination()
    return log


def _stream(build: Callable[[DataFrame, str], object], spark: SparkSession, sf_dir: str) -> tuple[str, ProgressLog]:
    """Run over the whole topic; returns the run's folder and log."""
    home = shared_dir(spark, "stream")
    return home, _run(build, spark, home, _topic(spark, sf_dir, f"{home}/topic"))


def _run_q1(window: str) -> Callable[[DataFrame, str], object]:
    def build(events, home):
        rows = jobs.temperature_stream(events, WINDOW_DAYS[window], USERS)
        return jobs.start_append(rows, f"{home}/out", f"{home}/checkpoint", once=True)

    return build


def _stream_q1(window: str) -> Query:
    return lambda spark, d: _stats(spark.read.parquet(f"{_stream(_run_q1(window), spark, d)[0]}/out"))


def _stream_q1_windows(spark, d):
    """The three windows from one streaming query, which reads each file once."""
    schema = "window_name string, ts long, vault_id long, count int, mean_s194 double, stddev_s194 double"

    def build(events, home):
        rows = jobs.temperature_windows_stream(events, WINDOW_DAYS, USERS)
        return jobs.start_windows(rows, _batch_folders(home), f"{home}/checkpoint", once=True)

    return _stats(_emitted(spark, _stream(build, spark, d)[0], schema))


def _batch_folders(home: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{home}/out/part{batch_id}")


def _emitted(spark: SparkSession, home: str, schema: str) -> DataFrame:
    return existing(lambda: spark.read.schema(schema).parquet(f"{home}/out/*"), spark, T._parse_datatype_string(schema))


def _stream_rankings(windows: dict[str, int]) -> Query:
    schema = "window_name string, ts long, vault_id long, day timestamp, failures long, rk int, disks array<string>"

    def build(events, home):
        return jobs.start_rankings(jobs.ranking_stream(events, windows), f"{home}/log", _batch_folders(home), f"{home}/checkpoint", once=True)

    return lambda spark, d: _as_text(_emitted(spark, _stream(build, spark, d)[0], schema))


def _stream_q2(window: str) -> Query:
    run = _stream_rankings({window: WINDOW_DAYS[window]})
    return lambda spark, d: _long(run(spark, d))


def _stream_q2_windows(spark, d):
    """The three windows from one streaming query and one state."""
    found = _stream_rankings(WINDOW_DAYS)(spark, d)
    return found.select("window_name", *_long(found).columns)


def _stream_late_drop(spark, d):
    """Run to the end, then let every user's first event arrive again and go on from the checkpoint.

    Those windows are closed, so the late rows change nothing; the run's progress counts them.
    """
    home = shared_dir(spark, "stream")
    topic = f"{home}/topic"
    files = _topic(spark, d, topic)
    _run(_run_q1("1d"), spark, home, files)
    events = spark.read.parquet(topic).filter("vault_id >= 0")
    first = events.groupBy("vault_id").agg(F.min_by(F.struct(*[c for c in events.columns if c != "vault_id"]), "seq").alias("e"))
    first.select(*[F.col("vault_id") if c == "vault_id" else F.col(f"e.{c}").alias(c) for c in events.columns]).coalesce(1).write.mode("append").parquet(topic)
    log = _run(_run_q1("1d"), spark, home, files)
    dropped = log.metrics().agg(F.sum("rows_dropped").alias("late_rows"))
    return _stats(spark.read.parquet(f"{home}/out")).join(F.broadcast(dropped))


def _stream_metrics(spark, d):
    """What the progress of a run says about the rows it has read, whatever the number of batches."""
    _, log = _stream(_run_q1("1d"), spark, d)
    return log.metrics().agg(F.sum("input_rows").alias("input_rows"), F.sum("rows_dropped").alias("rows_dropped"), (F.count_if(F.col("input_rows") > 0) >= 5).alias("several_batches"))


def _stream_latency(spark, d):
    """How long events wait for their windows to close, as if each arrived at its own time and windows came out at their end."""

    def build(events, home):
        counted = latency.arrivals(monotonous(events), WINDOW_DAYS, arrived=F.col("ts"))
        return latency.start_latency(counted, f"{home}/out", f"{home}/checkpoint", emitted=F.col("closed_ms"), once=True)

    return latency.latency(spark, f"{_stream(build, spark, d)[0]}/out")


def _llm_modules() -> list:
    """The modules that add queries on training data, where they are part of the installation."""
    names = ["vaultwatch.llm.queries", "corpus_pipeline"]
    there = importlib.util.find_spec("vaultwatch.llm") and all(importlib.util.find_spec(name) for name in names)
    return [importlib.import_module(name) for name in names] if there else []


def queries() -> dict[str, Query]:
    found = _telemetry_queries()
    for module in _llm_modules():
        found |= module.queries()
    return found


def _telemetry_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for window in WINDOW_DAYS:
        found[f"q1_{window}"] = _q1(window)
        found[f"q2_{window}"] = _q2(window)
        found[f"q2_{window}_wide"] = _q2_wide(window)
        found[f"q2_{window}_disks"] = _q2_disks(window)
        found[f"q2_{window}_pages"] = _q2_pages(window)
        found[f"stream_q1_{window}"] = _stream_q1(window)
        found[f"stream_q2_{window}"] = _stream_q2(window)
        if window != "1d":
            found[f"q1_rollup_{window}"] = _q1_rollup(window)
            found[f"q2_best_day_{window}"] = _q2_best_day(window)
    return found | {
        "q1_moments_daily": _q1_moments_daily,
        "q1_merge_moments": _q1_merge_moments,
        "q1_variances": _q1_variances,
        "q1_all_three": _q1_windows,
        "q2_daily_failures": _q2_daily_failures,
        "q2_all_three": _q2_windows,
        "q2_merge_rankings": _q2_merge_rankings,
        "q2_merge_pages": _q2_merge_pages,
        "ingest_clean": _ingest_clean,
        "ingest_rejects": _ingest_rejects,
        "json_roundtrip": _json_roundtrip,
        "event_gaps": _event_gaps,
        "closing_row": _closing_row,
        "stream_q1_all_three": _stream_q1_windows,
        "stream_q2_all_three": _stream_q2_windows,
        "stream_late_drop": _stream_late_drop,
        "stream_metrics": _stream_metrics,
        "stream_latency": _stream_latency,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Query 1 for one-day windows."""
    return queries()["q1_1d"](spark, "/root/testdata/sf0.001")


# The same results in SQL

_DAY_MS = 86_400_000
# The latest time a stream sees: that of the closing row, unless an earlier row is even later.
_CLOSED = (
    f"(SELECT greatest(epoch_ms(max_by(ts, event_id)) + {CLOSING_DAYS * _DAY_MS}, epoch_ms(max(ts)))"
    " FROM events WHERE value IS NOT NULL)"
)


def _bucket(days: int, ts: str) -> str:
    return f"time_bucket(INTERVAL '{days} days', {ts}, TIMESTAMP '1970-01-01')"


def _q1_sql(days: int, closed: bool = False) -> str:
    w = _bucket(days, "ts")
    last = f" AND epoch_ms({w}) + {days * _DAY_MS} <= {_CLOSED}" if closed else ""
    return f"""
        SELECT epoch_ms({w}) AS ts, user_id AS vault_id, CAST(count(value) AS INTEGER) AS count,
               round(round(avg(value), 9), 6) AS mean_s194, round(round(stddev_pop(value), 9), 6) AS stddev_s194
        FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND user_id BETWEEN {USERS[0]} AND {USERS[1]}{last}
        GROUP BY 1, 2"""


def _ranking_ctes(days: int) -> str:
    w = _bucket(days, "CAST(day AS TIMESTAMP)")
    return f"""
        WITH daily AS (
          SELECT date_trunc('day', ts) AS day, user_id AS vault_id, count(*) AS failures,
                 string_agg(CAST(event_id AS VARCHAR), ', ' ORDER BY ts, event_id) AS disks
          FROM events WHERE event_type = 'error' AND value IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
        placed AS (
          SELECT {w} AS w, *, row_number() OVER (PARTITION BY {w}, vault_id ORDER BY failures DESC, day) AS place
          FROM daily),
        best AS (SELECT * FROM placed WHERE place = 1),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY w ORDER BY failures DESC, day, vault_id) AS rk FROM best),
        top AS (SELECT epoch_ms(w) AS ts, * FROM ranked WHERE rk <= {RANKING_SLOTS})"""


def _q2_sql(days: int, closed: bool = False) -> str:
    last = f" WHERE ts + {days * _DAY_MS} <= {_CLOSED}" if closed else ""
    return f"{_ranking_ctes(days)} SELECT ts, CAST(rk AS INTEGER) AS rk, vault_id, failures, disks FROM top{last}"


def _q2_wide_sql(days: int) -> str:
    slots = ", ".join(
        f"max(CASE WHEN rk = {i} THEN vault_id END) AS vault_id{i},"
        f" CAST(max(CASE WHEN rk = {i} THEN failures END) AS INTEGER) AS failures{i},"
        f" max(CASE WHEN rk = {i} THEN disks END) AS failed_disks{i}"
        for i in range(1, RANKING_SLOTS + 1)
    )
    return f"{_ranking_ctes(days)} SELECT ts, {slots} FROM top GROUP BY ts"


def _q2_disks_sql(days: int) -> str:
    return f"""{_ranking_ctes(days)}
        SELECT top.ts AS ts, CAST(rk AS INTEGER) AS rk, vault_id, failures, epoch_us(e.ts) AS reported_us,
               CAST(e.event_id AS VARCHAR) AS disk
        FROM top JOIN events e ON e.user_id = top.vault_id AND date_trunc('day', e.ts) = top.day
        WHERE e.event_type = 'error' AND e.value IS NOT NULL"""


def _q2_pages_sql(days: int) -> str:
    return f"""{_ranking_ctes(days)},
        listed AS (
          SELECT top.ts AS ts, CAST(rk AS INTEGER) AS rk, vault_id, failures, CAST(e.event_id AS VARCHAR) AS disk,
                 row_number() OVER (PARTITION BY top.ts, vault_id ORDER BY e.event_id) - 1 AS pos
          FROM top JOIN events e ON e.user_id = top.vault_id AND date_trunc('day', e.ts) = top.day
          WHERE e.event_type = 'error' AND e.value IS NOT NULL)
        SELECT ts, rk, vault_id, failures, pos // {PAGE} AS page, string_agg(disk, ', ' ORDER BY pos) AS disks
        FROM listed GROUP BY 1, 2, 3, 4, 5"""


def _waits_sql(days: int) -> str:
    w = _bucket(days, "ts")
    return f"""
        SELECT epoch_ms({w}) AS ts, epoch_ms({w}) + {days * _DAY_MS} - epoch_ms(ts) // 1000 * 1000 AS wait
        FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND epoch_ms({w}) + {days * _DAY_MS} <= {_CLOSED}"""


def _latency_sql() -> str:
    least = ", ".join(f"min(CASE WHEN upto >= ({p} * n + 999) // 1000 THEN bucket END) AS {name}" for name, p in latency.PERMILLE.items())
    return f"""
        WITH waits AS ({_three(_waits_sql)}),
        shifted AS (SELECT *, greatest(length(bin(wait)) - {BITS}, 0) AS shift FROM waits),
        counted AS (SELECT window_name, ts, (wait >> shift) << shift AS bucket, count(*) AS k FROM shifted GROUP BY 1, 2, 3),
        summed AS (SELECT *, sum(k) OVER (PARTITION BY window_name, ts ORDER BY bucket) AS upto,
                   CAST(sum(k) OVER (PARTITION BY window_name, ts) AS BIGINT) AS n FROM counted)
        SELECT window_name, ts, n, {least} FROM summed GROUP BY 1, 2, 3"""


def _three(sql: Callable[..., str], **options) -> str:
    return " UNION ALL ".join(f"SELECT *, '{name}' AS window_name FROM ({sql(days, **options)})" for name, days in WINDOW_DAYS.items())


_RAW_SQL = """
    WITH cells AS (
      SELECT CASE WHEN value < 5 AND event_type = 'signup' THEN strftime(ts, '%Y-%m-%d')
                  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS c0,
             CAST(event_id AS VARCHAR) AS c1,
             CASE WHEN event_type = 'view' THEN '' ELSE event_type || ', "x"' END AS c2,
             CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 5 THEN 'x' ELSE '2' END
                  WHEN event_type = 'error' THEN '1' ELSE '0' END AS c3,
             CAST(user_id AS VARCHAR) || CASE WHEN value < 5 AND event_type = 'click' THEN '.5' ELSE '' END AS c4,
             CASE WHEN value < 5 AND event_type = 'view' THEN 'bad'
                  WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE '' END AS c12,
             CASE WHEN value < 5 AND event_type = 'error' THEN '' ELSE coalesce(CAST(value AS VARCHAR), '') END AS c25
      FROM events),
    judged AS (
      SELECT *, try_strptime(c0, '%Y-%m-%dT%H:%M:%S.%f') AS t,
             CASE WHEN try_strptime(c0, '%Y-%m-%dT%H:%M:%S.%f') IS NULL THEN 'date'
                  WHEN NOT regexp_full_match(c3, '[+-]?[0-9]+') THEN 'failure'
                  WHEN NOT regexp_full_match(c4, '[+-]?[0-9]+') THEN 'vault_id'
                  WHEN c12 <> '' AND TRY_CAST(c12 AS DOUBLE) IS NULL THEN 's9_power_on_hours'
                  WHEN c25 <> '' AND TRY_CAST(c25 AS DOUBLE) IS NULL THEN 's194_temperature_celsius' END AS reason
      FROM cells)"""


def oracle_sql() -> dict[str, str]:
    found = _telemetry_sql()
    for module in _llm_modules():
        found |= module.oracle_sql()
    return found


def _telemetry_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for window, days in WINDOW_DAYS.items():
        found[f"q1_{window}"] = _q1_sql(days)
        found[f"q2_{window}"] = _q2_sql(days)
        found[f"q2_{window}_wide"] = _q2_wide_sql(days)
        found[f"q2_{window}_disks"] = _q2_disks_sql(days)
        found[f"q2_{window}_pages"] = _q2_pages_sql(days)
        found[f"stream_q1_{window}"] = _q1_sql(days, closed=True)
        found[f"stream_q2_{window}"] = _q2_sql(days, closed=True)
        if window != "1d":
            found[f"q1_rollup_{window}"] = _q1_sql(days)
            found[f"q2_best_day_{window}"] = (
                f"{_ranking_ctes(days)} SELECT epoch_ms(w) AS ts, vault_id, epoch_ms(CAST(day AS TIMESTAMP)) AS day, failures, disks FROM best"
            )
    return found | {
        "q1_moments_daily": f"""
            SELECT epoch_ms({_bucket(1, 'ts')}) AS ts, user_id AS vault_id, count(value) AS count,
                   round(round(avg(value), 9), 6) AS mean, round(round(var_pop(value) * count(value), 9), 6) AS m2
            FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND user_id BETWEEN {USERS[0]} AND {USERS[1]}
            GROUP BY 1, 2""",
        "q1_merge_moments": f"""
            WITH v AS (SELECT epoch_ms({_bucket(1, 'ts')}) AS ts, user_id AS vault_id, round(value * 4) / 4 AS x FROM events
                       WHERE value IS NOT NULL AND ts IS NOT NULL AND user_id BETWEEN {USERS[0]} AND {USERS[1]})
            SELECT ts, vault_id, count(*) AS count, round(round(avg(x) + {LIFT}, 6), 4) AS mean,
                   round(round(sum(x * x) - sum(x) * sum(x) / count(*), 4), 1) AS m2
            FROM v GROUP BY 1, 2""",
        "q1_variances": f"""
            SELECT epoch_ms({_bucket(1, 'ts')}) AS ts, user_id AS vault_id, CAST(count(value) AS INTEGER) AS count,
                   round(round(avg(value), 9), 6) AS mean_s194,
                   CASE WHEN count(value) < 2 THEN CAST('nan' AS DOUBLE) ELSE round(round(var_pop(value), 9), 6) END AS variance,
                   CASE WHEN count(value) < 2 THEN CAST('nan' AS DOUBLE) ELSE round(round(var_samp(value), 9), 6) END AS sample_variance
            FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND user_id BETWEEN {USERS[0]} AND {USERS[1]}
            GROUP BY 1, 2""",
        "q1_all_three": _three(_q1_sql),
        "q2_daily_failures": f"{_ranking_ctes(1)} SELECT epoch_ms(CAST(day AS TIMESTAMP)) AS ts, vault_id, failures, disks FROM daily",
        "q2_all_three": _three(_q2_sql),
        "q2_merge_rankings": _q2_sql(WINDOW_DAYS["all"]),
        "q2_merge_pages": _q2_pages_sql(WINDOW_DAYS["all"]),
        "ingest_clean": f"""{_RAW_SQL}
            SELECT epoch_us(t) AS ts_us, c1 AS serial_number, c2 AS model, CAST(c3 AS INTEGER) <> 0 AS failure,
                   CAST(c4 AS INTEGER) AS vault_id, round(TRY_CAST(c12 AS DOUBLE), 2) AS s9_power_on_hours,
                   round(TRY_CAST(c25 AS DOUBLE), 2) AS s194_temperature_celsius
            FROM judged WHERE reason IS NULL AND c25 <> ''""",
        "ingest_rejects": f"{_RAW_SQL} SELECT c1 AS serial_number, reason FROM judged WHERE reason IS NOT NULL",
        "json_roundtrip": """
            SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS date, CAST(event_id AS VARCHAR) AS serial_number,
                   'M' AS model, event_type = 'error' AS failure, CAST(user_id AS INTEGER) AS vault_id,
                   CAST(NULL AS FLOAT) AS s9_power_on_hours, round(value, 2) AS s194_temperature_celsius
            FROM events WHERE value IS NOT NULL""",
        "event_gaps": """
            SELECT event_id AS seq, epoch_us(ts) AS ts_us,
                   round((epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY event_id)) / 1000000.0, 6) AS gap_seconds
            FROM events WHERE value IS NOT NULL AND ts IS NOT NULL""",
        "closing_row": f"""
            SELECT strftime(ts + INTERVAL '{CLOSING_DAYS} days', '%Y-%m-%dT%H:%M:%S.%f') AS date, event_id AS seq,
                   user_id AS vault_id, value AS s194_temperature_celsius, event_type = 'error' AS failure
            FROM events WHERE value IS NOT NULL ORDER BY event_id DESC LIMIT 1""",
        "stream_latency": _latency_sql(),
        "stream_q1_all_three": _three(_q1_sql, closed=True),
        "stream_q2_all_three": _three(_q2_sql, closed=True),
        "stream_late_drop": f"""
            SELECT *, (SELECT count(DISTINCT user_id) FROM events WHERE value IS NOT NULL
                       AND user_id BETWEEN {USERS[0]} AND {USERS[1]}) AS late_rows FROM ({_q1_sql(1, closed=True)})""",
        "stream_metrics": """
            SELECT CAST(count(*) + 1 AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS rows_dropped, true AS several_batches
            FROM events WHERE value IS NOT NULL""",
    }
