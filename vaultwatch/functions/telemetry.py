"""Small expressions on drive events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a raw cell. The JVM parser alone would also take "1.5d" and "1.5f".
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def disk_label(model: str = "model", serial: str = "serial_number") -> Column:
    return F.concat_ws(",", F.col(model), F.col(serial))


def join_disks(disks: Column) -> Column:
    return F.array_join(disks, ", ")


def as_int(cell: Column) -> Column:
    return cell.try_cast("int")


def as_float(cell: Column) -> Column:
    return F.when(cell.rlike(_NUMBER), F.trim(cell).try_cast("float"))


def is_blank(cell: Column) -> Column:
    return cell.isNull() | (cell == "")


def scaled(interval: Column, factor: float) -> Column:
    """An interval at ``factor`` times its speed."""
    return interval / F.lit(float(factor))
