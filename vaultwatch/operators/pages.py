"""Lists of failed disks as numbered pages, for vaults and days whose list is beyond what one cell may hold.

A page is a row with at most so many disks. Pages of one list follow each other in the order of arrival, so a reader
goes through a list of any length, and joins and merges move pages, never lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.operators.ranking import CHUNK_ROWS, by_arrival, failed_disks, merge_rankings, ranked
from vaultwatch.schemas import RANKING_SLOTS
from vaultwatch.sources.shared import settle

PAGE_ROWS = 100_000


def numbered(rows: DataFrame, groups: list[str], chunk: Column, order: list[str]) -> DataFrame:
    """The rows with their place in their group, ``pos`` from 0, in ``order``; ``chunk`` must not decrease along it.

    No task sees a whole group: the chunks are counted, the running sum of the counts says where each begins, and
    rows are numbered within their chunk. Only the counts of a group, a row per chunk, come together. The rows are
    settled, as they are looked at twice; the begins too, so that their join goes by their size.
    """
    rows = settle(rows.withColumn("chunk", chunk), "paged-rows")
    ahead = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*groups, "chunk").agg(F.count("*").alias("n"))
    begins = settle(counts.select(*groups, "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")).alias("begin")), "page-begins")
    within = Window.partitionBy(*groups, "chunk").orderBy(*order)
    placed = rows.withColumn("within", F.row_number().over(within)).join(begins, [*groups, "chunk"])
    return placed.withColumn("pos", F.col("begin") + F.col("within") - 1).drop("begin", "within", "chunk")


def paged_disks(
    df: DataFrame,
    vault_days: DataFrame,
    key: str = "vault_id",
    label: str = "disk",
    seq: str = "seq",
    rows_per_page: int = PAGE_ROWS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """The settled (vault, day) rows, once per page of their list, with ``page`` from 0 and its ``disks``.

    Every page but a list's last holds ``rows_per_page`` disks. Reports that share their ``seq`` go by label. Pages
    are built where their rows are dealt by list and page, so a vault with most of the reports goes to many tasks.
    """
    if rows_per_page < 1 or rows_per_chunk < 1:
        raise ValueError("pages and chunks hold at least one row")
    groups = vault_days.columns
    reports = failed_disks(df, vault_days, key).select(*groups, F.col(seq).alias("seq"), F.col(label).alias("label"))
    placed = numbered(reports, groups, by_arrival(reports, "seq", rows_per_chunk), ["seq", "label"])
    page = F.expr(f"pos div {rows_per_page}").alias("page")
    listed = F.sort_array(F.collect_list(F.struct("pos", "label")))
    return placed.groupBy(*groups, page).agg(F.transform(listed, lambda x: x["label"]).alias("disks"))


def ranked_with_pages(df: DataFrame, days: int, k: int = RANKING_SLOTS, key: str = "vault_id", rows_per_page: int = PAGE_ROWS) -> DataFrame:
    """As :func:`ranking.ranked_with_disks`, a row per page of a winner's list."""
    return paged_disks(df, settle(ranked(df, days, k, key), "ranking"), key, rows_per_page=rows_per_page)


def merge_paged(a: DataFrame, b: DataFrame, k: int = RANKING_SLOTS, key: str = "vault_id") -> DataFrame:
    """Merge two paged rankings of the same windows over different days into that of all days.

    The first pages stand for the lists: they are merged on counts as :func:`ranking.merge_rankings` does it, and the
    pages of the winners follow by a join. No list is put together or opened.
    """
    heads = [side.filter("page = 0").drop("page", "disks") for side in (a, b)]
    winners = settle(merge_rankings(*heads, k, key), "merged-ranking").select("ts", key, "day", "rk")
    return a.drop("rk").unionByName(b.drop("rk")).join(winners, ["ts", key, "day"]).select(*a.columns)
