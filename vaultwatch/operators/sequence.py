"""Operators on the order of a file: gaps between consecutive events, and the closing row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.sources.shared import settle


def event_gaps(df: DataFrame, seq: str = "seq", ts: str = "ts") -> DataFrame:
    """Seconds since the previous event in file order; null for the first. ``seq`` is a number or a place.

    A window over the whole file would run in one task. The file is dealt to tasks by ranges of its order instead,
    and the first event of a range takes its predecessor from a table with the last event of each. Ranges and
    their number follow the session's shuffle partitions; the table has a row for each.
    """
    rows = df.filter(F.col(ts).isNotNull() & F.col(seq).isNotNull())
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(width, seq).sortWithinPartitions(seq)
    placed = settle(ordered.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "file-order")
    tails = placed.groupBy("_part").agg(F.max_by(ts, "_row").alias("_last"))
    heads = tails.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_before"))  # a row per range
    within = Window.partitionBy("_part").orderBy("_row")
    return (
        placed.join(heads, "_part")
        .withColumn("_previous", F.coalesce(F.lag(ts).over(within), F.col("_before")))
        .withColumn("gap_seconds", (F.unix_micros(ts) - F.unix_micros("_previous")) / F.lit(1e6))
        .drop("_row", "_part", "_before", "_previous")
    )


def closing_row(df: DataFrame, seq: str = "seq", ts: str = "ts", days: int = 7) -> DataFrame:
    """Copy of the last row, dated ``days`` later, to be the last row of a stream.

    Each task keeps one row, and one of these is chosen.
    """
    return df.orderBy(F.desc(seq)).limit(1).withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {days} DAYS"))
