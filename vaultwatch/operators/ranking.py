"""Vaults with the most failures within one day.

The order is the same everywhere: failures descending, then the earlier day, then the lower vault id.
Batch rankings are decided on counts alone; disk names are fetched afterwards, for the winners only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.functions.eventtime import DAY_MS, event_time_filter, grid_start, in_windows, start_ms, tumbling
from vaultwatch.functions.telemetry import join_disks
from vaultwatch.schemas import RANKING_SLOTS
from vaultwatch.sources.shared import settle


def failing(df: DataFrame, flag: str = "failure", ts: str = "ts") -> DataFrame:
    """Dated failure reports. A null flag is not a failure."""
    return event_time_filter(df, F.col(flag), ts)


def daily_counts(df: DataFrame, key: str = "vault_id", ts: str = "ts", flag: str = "failure") -> DataFrame:
    """Failures per day and vault, one partial count per task and group."""
    grouped = failing(df, flag, ts).groupBy(grid_start(ts, 1).alias("w"), key)
    return grouped.agg(F.count("*").alias("failures")).select(F.timestamp_millis("w").alias("day"), key, "failures")


def best_day(daily: DataFrame, days: int, key: str = "vault_id", offset_days: int = 0) -> DataFrame:
    """Each vault's best single day in the window, the earliest of equals.

    Count and day are packed into one long, so that the maximum is a plain hash aggregate: with
    ``i`` the day's place in the window, a larger ``failures * days + (days - 1 - i)`` is a larger
    count or, for the same count, an earlier day.
    """
    if days == 1 and not offset_days:  # a day is a window; the rows are unique already
        return daily.select(F.unix_millis("day").alias("ts"), key, "day", "failures")
    placed = daily.withColumn("w", grid_start("day", days, offset_days))
    place = F.expr(f"(unix_millis(day) - w) div {DAY_MS}")
    packed = F.max(F.col("failures") * days + (F.lit(days - 1) - place)).alias("packed")
    day_ms = F.col("w") + (F.lit(days - 1) - F.col("packed") % days) * DAY_MS
    return (
        placed.groupBy("w", key)
        .agg(packed)
        .select(
            F.col("w").alias("ts"),
            key,
            F.timestamp_millis(day_ms).alias("day"),
            F.expr(f"packed div {days}").alias("failures"),
        )
    )


def top_vaults(best: DataFrame, k: int = RANKING_SLOTS, key: str = "vault_id", window: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The ``k`` first vaults of each window, numbered in ``rk``; ``window`` are the columns that name it.

    Every task cuts its own rows to ``k`` per window before the shuffle, so a window never gathers
    more than ``k`` rows per task.
    """
    order = Window.partitionBy(*window).orderBy(F.desc("failures"), F.asc("day"), F.asc(key))
    return best.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= k)


def failed_disks(df: DataFrame, vault_days: DataFrame, key: str = "vault_id", ts: str = "ts", flag: str = "failure") -> DataFrame:
    """One row per failure report of the given (vault, day) rows, with that row's columns.

    ``vault_days`` should be settled: the planner then broadcasts it if it is small and else shuffles both sides.
    Adaptive execution can then split a vault that holds much of the data, as long as nothing above the join needs
    the rows of a vault together; :func:`ordered_lists` deals them anew for that reason.
    """
    reports = failing(df, flag, ts).withColumn("day", F.timestamp_millis(grid_start(ts, 1)))
    return reports.withColumnRenamed(ts, "reported").join(
        vault_days, (reports[key] == vault_days[key]) & (reports["day"] == vault_days["day"])
    ).drop(reports[key], reports["day"])


CHUNK_ROWS = 10_000


def by_arrival(df: DataFrame, seq: str = "seq", rows: int = CHUNK_ROWS) -> Column:
    """Chunk of a list: a stretch of ``rows`` in the order of arrival, so that events of one instant divide as well.

    ``seq`` is a number, or a place (struct) whose last field is the number of a row within the other fields.
    """
    kind = df.schema[seq].dataType
    if kind.typeName() != "struct":
        return F.expr(f"`{seq}` div {rows}")
    *outer, last = kind.fieldNames()
    return F.struct(*[F.col(seq)[name].alias(name) for name in outer], F.floor(F.col(seq)[last] / rows).alias(last))


def ordered_lists(rows: DataFrame, groups: list[str], chunk: Column, order: list[str], label: str = "disk") -> DataFrame:
    """Per group the number of rows and the list of their labels, duplicates kept, in ``order``.

    Two levels: rows are sorted and collected within chunks of a group, and the final step only strings finished
    chunks together. Tables are dealt by group and chunk first, so the chunks of a hot group go to many tasks even
    where the rows come from a join that has brought the group together. ``chunk`` must not decrease along
    ``order``. Runs on streams as well.
    """
    rows = rows.withColumn("chunk", chunk)
    if not rows.isStreaming:
        rows = rows.repartition(*groups, "chunk")
    listed = F.sort_array(F.collect_list(F.struct(*order, F.col(label).alias("label"))))
    pieces = rows.groupBy(*groups, "chunk").agg(
        F.count("*").alias("n"), F.transform(listed, lambda x: x["label"]).alias("labels")
    )
    chunks = F.sort_array(F.collect_list(F.struct("chunk", "labels")))
    return pieces.groupBy(*groups).agg(
        F.sum("n").alias("failures"), F.flatten(F.transform(chunks, lambda x: x["labels"])).alias("disks")
    )


def daily_failures(
    df: DataFrame,
    key: str = "vault_id",
    ts: str = "ts",
    flag: str = "failure",
    label: str = "disk",
    seq: str = "seq",
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Failures and disk list per day window ``w`` and vault, in order of arrival, for batch and streams."""
    rows = failing(df, flag, ts).withColumn("w", tumbling(ts, 1))
    return ordered_lists(rows, ["w", key], by_arrival(df, seq, rows_per_chunk), [seq], label)


def best_day_with_disks(daily: DataFrame, days: int, key: str = "vault_id") -> DataFrame:
    """As :func:`best_day` for rows of :func:`daily_failures`, the disk list going with its day.

    The form where the lists are at hand and a second look at the events is not possible.
    """
    record = F.struct("failures", (-start_ms("w")).alias("earlier"), "disks")
    best = daily.groupBy(tumbling("w", days).alias("wide"), key).agg(F.max(record).alias("best"))
    return best.select(
        start_ms("wide").alias("ts"),
        key,
        F.timestamp_millis(-F.col("best.earlier")).alias("day"),
        F.col("best.failures").alias("failures"),
        F.col("best.disks").alias("disks"),
    )


def best_days_counted(df: DataFrame, windows: dict[str, int], key: str = "vault_id", ts: str = "ts", flag: str = "failure") -> DataFrame:
    """Each vault's best single day, as :func:`best_day`, in several windows (name: days) of a stream.

    Rows (window_name, ts, vault, day, failures, until) as windows close. The state is two numbers per open day and
    vault and three per open window and vault, however many failures there are. ``until`` is the time of the last
    batch that a counted failure came with. Later reports of that day came too late, as a day closes for all at once;
    so reports up to ``until`` are the ones that were counted.
    """
    reports = failing(df, flag, ts).withColumn("at", F.current_timestamp())
    daily = reports.groupBy(tumbling(ts, 1).alias("w"), key).agg(F.count("*").alias("failures"), F.max("at").alias("until"))
    placed = in_windows(daily.withColumn("day", F.col("w.start")), "day", windows, mark="w")
    record = F.struct("failures", (-F.unix_millis("day")).alias("earlier"), "until")
    best = placed.groupBy("window_name", "w", key).agg(F.max(record).alias("best"))
    return best.select(
        "window_name",
        start_ms("w").alias("ts"),
        key,
        F.timestamp_millis(-F.col("best.earlier")).alias("day"),
        F.col("best.failures").alias("failures"),
        F.col("best.until").alias("until"),
    )


def counted_reports(df: DataFrame, key: str = "vault_id", ts: str = "ts", flag: str = "failure", label: str = "disk", seq: str = "seq") -> DataFrame:
    """The failure reports of each batch of a stream as they come: (vault, day, seq, disk, until), the batch's time."""
    day = F.timestamp_millis(grid_start(ts, 1))
    return df.filter(F.col(ts).isNotNull() & F.col(flag)).select(
        key, day.alias("day"), F.col(seq).alias("seq"), F.col(label).alias("disk"), F.current_timestamp().alias("until")
    )


def with_counted_disks(reports: DataFrame, winners: DataFrame, key: str = "vault_id", rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add the ``disks`` list to winners of :func:`best_days_counted` from the logged :func:`counted_reports`."""
    columns = [c for c in winners.columns if c != "until"]
    wanted = winners.withColumnsRenamed({"failures": "expected", "until": "last"})
    same = (reports[key] == wanted[key]) & (reports["day"] == wanted["day"]) & (reports["until"] <= wanted["last"])
    rows = reports.join(wanted, same).drop(reports[key], reports["day"])
    groups = ["expected" if c == "failures" else c for c in columns]
    return ordered_lists(rows, groups, by_arrival(reports, "seq", rows_per_chunk), ["seq"]).select(*columns, "disks")


def with_disks(
    df: DataFrame,
    vault_days: DataFrame,
    key: str = "vault_id",
    label: str = "disk",
    seq: str = "seq",
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the ``disks`` list, in order of arrival, to settled (vault, day) rows."""
    columns = vault_days.columns
    rows = failed_disks(df, vault_days, key).withColumnRenamed("failures", "expected")
    groups = ["expected" if c == "failures" else c for c in columns]
    return ordered_lists(rows, groups, by_arrival(df, seq, rows_per_chunk), [seq], label).select(*columns, "disks")


def ranked(df: DataFrame, days: int, k: int = RANKING_SLOTS, key: str = "vault_id") -> DataFrame:
    """Top ``k`` vaults per window on counts: (ts, vault, day, failures, rk)."""
    return top_vaults(best_day(daily_counts(df, key), days, key), k, key)


def ranked_with_disks(df: DataFrame, days: int, k: int = RANKING_SLOTS, key: str = "vault_id") -> DataFrame:
    """Top ``k`` vaults per window, each with the list of its failed disks.

    Two scans: counts decide the ranking, which is at most ``k`` small rows per window; the second
    scan keeps only the winners' reports, so no other disk name is ever shuffled.
    """
    winners = settle(ranked(df, days, k, key), "ranking")
    return with_disks(df, winners, key)


def merge_rankings(a: DataFrame, b: DataFrame, k: int = RANKING_SLOTS, key: str = "vault_id") -> DataFrame:
    """Merge two rankings of the same windows over different days into the ranking of all days."""
    first = Window.partitionBy("ts", key).orderBy(F.desc("failures"), F.asc("day"), F.asc("side"))
    both = a.drop("rk").withColumn("side", F.lit(0)).unionByName(b.drop("rk").withColumn("side", F.lit(1)))
    best = both.withColumn("place", F.row_number().over(first)).filter(F.col("place") == 1).drop("place", "side")
    return top_vaults(best, k, key)


def widen(ranking: DataFrame, k: int = RANKING_SLOTS, key: str = "vault_id", disks: str = "disks") -> DataFrame:
    """One row per window with ``k`` slots of (vault, failures, disks); unused slots are null.

    ``disks`` may be a list or joined text. A window gathers its ``k`` ranked rows and no more.
    """
    text = join_disks(F.col(disks)) if ranking.schema[disks].dataType.typeName() == "array" else F.col(disks)
    slot = F.struct("rk", key, "failures", text.alias("disks"))
    rows = ranking.groupBy("ts").agg(F.sort_array(F.collect_list(slot)).alias("slots"))
    columns = []
    for i in range(k):
        entry = F.get("slots", F.lit(i))
        columns += [
            entry[key].alias(f"vault_id{i + 1}"),
            entry["failures"].cast("int").alias(f"failures{i + 1}"),
            entry["disks"].alias(f"failed_disks{i + 1}"),
        ]
    return rows.select("ts", *columns)
