"""Quantiles of whole numbers by a sketch that adds up: counts of values by their leading bits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 7


def leading(value: Column, bits: int = BITS) -> Column:
    """The value with all but its ``bits`` leading bits cleared, the least value of its bucket; 0 for negative ones.

    Values below ``2 ** bits`` stand for themselves, others are at most a ``2 ** (bits - 1)``-th above their bucket.
    """
    whole = F.greatest(value.cast("long"), F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(whole)) - F.lit(bits), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", whole, shift), shift)


def sketch(df: DataFrame, by: list[str], value: str, weight: str | None = None, bits: int = BITS) -> DataFrame:
    """Rows (``by``, bucket, n): how many values, or what ``weight`` of them, a bucket holds.

    A group has some thousand rows at most (64 a doubling of the value), however many values there are; each task
    sends so many. Null values are left out.
    """
    count = F.count("*") if weight is None else F.sum(weight)
    known = df.filter(F.col(value).isNotNull())
    return known.groupBy(*by, leading(F.col(value), bits).alias("bucket")).agg(count.cast("long").alias("n"))


def merge(sketches: list[DataFrame], by: list[str]) -> DataFrame:
    """The sketch of all values of several, whatever order and parts they come in."""
    return reduce(DataFrame.unionByName, sketches).groupBy(*by, "bucket").agg(F.sum("n").cast("long").alias("n"))


def quantiles(sketched: DataFrame, by: list[str], permille: dict[str, int]) -> DataFrame:
    """Per group ``n`` and, under each name, the bucket of the least value that has so many thousandths at or below it."""
    if not all(0 <= p <= 1000 for p in permille.values()):
        raise ValueError("quantiles are thousandths from 0 to 1000")
    group = Window.partitionBy(*by)
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sketched.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(group)})
    found = [F.min(F.when(F.col("upto") >= F.expr(f"greatest(1, ({p} * total + 999) div 1000)"), F.col("bucket"))).alias(name) for name, p in permille.items()]
    return summed.groupBy(*by).agg(F.max("total").alias("n"), *found)
