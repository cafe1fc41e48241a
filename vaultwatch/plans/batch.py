"""Query 1 and Query 2 over a table of events.

Query 1: count, mean and deviation of the temperature per vault and window, for a range of vaults.
Query 2: per window the ten vaults with the most failures within one day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.functions.eventtime import DAY_MS, grid_start, with_event_time
from vaultwatch.functions.telemetry import disk_label
from vaultwatch.operators import moments, ranking
from vaultwatch.schemas import QUERY_RESULTS, WINDOW_DAYS, result_topic, windows_for
from vaultwatch.sources.results import declared, write_result
from vaultwatch.sources.shared import settle


def prepare(events: DataFrame) -> DataFrame:
    """Events as published: event time from the date text, ``disk`` as label; ``seq``, their arrival, must be there."""
    if "seq" not in events.columns:
        raise ValueError("events need their order of arrival in a column seq, as the sources give it")
    df = events if "ts" in events.columns else with_event_time(events)
    return df if "disk" in df.columns else df.withColumn("disk", disk_label())


def query1(events: DataFrame, window: str, bounds: tuple[int, int] | None = moments.VAULT_RANGE) -> DataFrame:
    return moments.windowed_stats(prepare(events), WINDOW_DAYS[window], bounds)


def query2(events: DataFrame, window: str) -> DataFrame:
    """Long form: (ts, vault_id, day, failures, rk, disks)."""
    return ranking.ranked_with_disks(prepare(events), WINDOW_DAYS[window])


def query1_windows(events: DataFrame, windows: str | list[str], bounds: tuple[int, int] | None = moments.VAULT_RANGE) -> dict[str, DataFrame]:
    """All chosen windows from one scan: the daily moments are kept and rolled up."""
    daily = settle(moments.daily_moments(prepare(events), bounds), "daily-moments")
    return {name: moments.rollup_stats(daily, WINDOW_DAYS[name]) for name in windows_for(windows)}


def query2_windows(events: DataFrame, windows: str | list[str]) -> dict[str, DataFrame]:
    """All chosen windows from two scans: one for the daily counts, one for the winners' disks."""
    df = prepare(events)
    names = windows_for(windows)
    daily = settle(ranking.daily_counts(df), "daily-failures")
    tops = [
        ranking.top_vaults(ranking.best_day(daily, WINDOW_DAYS[name])).withColumn("window_name", F.lit(name)) for name in names
    ]
    winners = settle(reduce(DataFrame.unionByName, tops), "rankings")
    listed = settle(ranking.with_disks(df, winners), "ranked-disks")
    return {name: listed.filter(F.col("window_name") == name).drop("window_name") for name in names}


def result_rows(query: str, df: DataFrame) -> DataFrame:
    """A query's rows in the declared result form."""
    return declared(ranking.widen(df) if query == "query2" else df, QUERY_RESULTS[query])


def run_batch(query: str, windows: str | list[str], events: DataFrame, out_dir: str) -> list[str]:
    """Run a query for the chosen windows and replace their result files. Returns the topics written."""
    build = {"query1": query1_windows, "query2": query2_windows}[query]
    topics = []
    for name, rows in build(events, windows).items():
        topics.append(result_topic(query, name))
        write_result(result_rows(query, rows), out_dir, topics[-1])
    return topics


def first_part(df: DataFrame, days: int, split: int) -> tuple[DataFrame, DataFrame]:
    """Cut every window of ``days`` after ``split`` days: the events before and from there."""
    early = F.unix_millis("ts") - grid_start("ts", days) < split * DAY_MS
    return df.filter(early), df.filter(~early)
