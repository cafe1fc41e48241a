"""Documents to shards of near equal bytes: longest-processing-time scheduling of groups of equal texts.

Groups are sorted by size, and each goes to the shard with the least load. Only the histogram of group
sizes passes through the driver; the groups find their shard by their place among those of equal size,
so the result is that of placing them one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.llm.common import settle

LAW = "bytes"


def deal(runs: Iterable[tuple[int, int]], shards: int) -> Iterable[list[int]]:
    """How many of each run's ``count`` groups of equal ``size`` every shard gets; runs come largest first.

    The same as taking the least-loaded shard from a heap for each group. While a run has enough groups
    left to lift all loads to a common level, that part is dealt at once, and the heap places the rest.
    """
    loads = [0] * shards
    for size, count in runs:
        got = [0] * shards
        if count > shards:
            low, high = min(loads), min(loads) + size * (count + 1)
            while low < high:  # the highest level that the run can surely fill
                middle = (low + high + 1) // 2
                if sum(max(0, (middle - load) // size) for load in loads) <= count - shards:
                    low = middle
                else:
                    high = middle - 1
            got = [max(0, (low - load) // size) for load in loads]
        heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, got))]
        heapq.heapify(heap)
        for _ in range(count - sum(got)):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            got[shard] += 1
        loads = [load + n * size for load, n in zip(loads, got)]
        yield got


def _numbered(df: DataFrame, order: list[Column], purpose: str) -> DataFrame:
    """The rows in a global order; ``row`` rises along it, without gaps within a part, ``part`` is the task."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = settle(ordered.withColumn("row", F.monotonically_increasing_id()), purpose)
    return numbered.withColumn("part", F.shiftright("row", 33))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key, size, text_crc32, law, shard, slot and grown_shard (null: this law has none).

    Rows of equal text stay together; null texts are one group, apart from empty ones, and their CRC is that
    of no bytes. The slot is the row's place in its shard by key, gapless from 0. Repeated and null keys keep
    their rows. Columns other than key and text are left out; an empty table gives no rows.
    """
    bytes_of = F.coalesce(F.octet_length(text), F.lit(0))
    rows = docs.select(
        F.col(key).alias("key"),
        (bytes_of + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
        F.coalesce(F.unhex(F.sha2(F.col(text), 256)), F.lit(b"")).alias("digest"),
    )
    rows = settle(rows, "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("total"))
    groups = _numbered(groups, [F.col("total").desc(), F.col("digest")], "shard-groups")
    runs = groups.groupBy("total", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    placed = runs.orderBy(F.desc("total"), "part").collect()  # one row per size and part, whatever the number of groups
    plan = []
    at = 0
    while at < len(placed):
        end = at
        while end < len(placed) and placed[end]["total"] == placed[at]["total"]:
            end += 1
        plan.append((at, end))
        at = end
    sizes = ((placed[a]["total"], sum(r["n"] for r in placed[a:b])) for a, b in plan)
    table = []
    for (a, b), got in zip(plan, deal(sizes, shards)):
        upto = [sum(got[: i + 1]) for i in range(shards)]
        before = 0
        for r in placed[a:b]:
            table.append((r["total"], r["part"], r["first"] - before, upto))
            before += r["n"]
    spark = docs.sparkSession
    dealt = spark.createDataFrame(table, "total long, part long, origin long, upto array<long>")
    place = F.col("row") - F.col("origin")
    shard = F.size(F.filter("upto", lambda u: u <= place))
    homes = groups.join(dealt, ["total", "part"]).select("digest", shard.cast("int").alias("shard"))
    housed = rows.join(homes, "digest").drop("digest")
    housed = _numbered(housed, [F.col("shard"), F.col("key"), F.col("crc")], "shard-slots")
    heads = housed.groupBy("shard", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    heads = heads.select("shard", "part", (F.col("first") - before).alias("origin"))
    return housed.join(heads, ["shard", "part"]).select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("row") - F.col("origin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
