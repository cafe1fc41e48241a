"""Exact duplicates by a persistent index of digests, bucketed and sorted by digest.

The index is a folder with two Parquet tables of the same buckets. ``entries`` has one row per digest, with the row
that stays; ``sightings`` has one row per batch and digest, with the number of copies. New data is reduced to a row
per digest (copies are combined in the tasks, so a text that a third of the rows hold costs one row per task), written
to its buckets, and joined with the entries by a sort-merge anti-join to which neither side is shuffled. What is left
is appended to the entries. A state file, written last, names the batches that count: what a lost driver has left
half written is in no state file and never read.

What has entered the index stays, so of equal texts of two batches the earlier one's is kept.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwatch.llm.common import settle, shuffle_width
from vaultwatch.sources.shared import shared_dir

_COLUMNS = {
    "entries": "digest BINARY, keep_id BIGINT, keep_row BIGINT, batch BIGINT",
    "sightings": "digest BINARY, keep_id BIGINT, keep_row BIGINT, copies BIGINT, batch BIGINT",
}
_LEAST = -(2**63)
# A text counts as hot from this part of a task's fair share of the rows, so there are at most so many hot ones a task.
HOT_SHARE = 8


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, digest (SHA-256 of the text in UTF-8, null as empty) and a number, settled so that it is fixed."""
    digest = F.unhex(F.sha2(F.coalesce(docs[text], F.lit("")).cast("binary"), 256))
    rows = docs.select(docs[key].cast("long").alias("key"), digest.alias("digest"))
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "digest-rows")


class DigestIndex:
    """Open or make one with :meth:`open`; a handle is for one session, the folder for as many as needed."""

    def __init__(self, spark: SparkSession, home: str, state: dict, number: int):
        self.spark, self.home, self._state, self._number = spark, home.rstrip("/"), state, number

    @classmethod
    def open(cls, spark: SparkSession, home: str, buckets: int | None = None) -> DigestIndex:
        """The index in the folder ``home``, or a new one of so many buckets (else the session's shuffle partitions).

        The number of buckets is fixed for the index's life: choose it for the digests it grows to, 48 bytes each.
        """
        where, files = _file_system(spark, f"{home.rstrip('/')}/state-*.json")
        found = sorted(status.getPath().toString() for status in files.globStatus(where) or [])
        if not found:
            index = cls(spark, home, {"buckets": buckets or shuffle_width(spark), "version": 0, "batches": []}, 0)
            index._save()
            return index
        text = spark.read.text(found[-1], wholetext=True).first()[0]
        return cls(spark, home, json.loads(text), int(found[-1].rsplit("-", 1)[1].removesuffix(".json")))

    def _save(self) -> None:
        """Write the state under the next number; a rename makes it visible whole, and fails if another was first."""
        number = self._number + 1
        path = f"{self.home}/state-{number:08d}.json"
        where, files = _file_system(self.spark, path)
        part, _ = _file_system(self.spark, f"{self.home}/writing-{uuid.uuid4().hex}")
        out = files.create(part)
        out.write(bytearray(json.dumps(self._state).encode()))
        out.close()
        if files.exists(where) or not files.rename(part, where):
            raise RuntimeError(f"the index was changed by another writer: {path}")
        self._number = number

    def _table(self, kind: str) -> str:
        """The catalog's name for a table of the index; the catalog knows the buckets, the files lie in the folder."""
        path = f"{self.home}/v{self._state['version']}/{kind}"
        name = f"digest_{kind}_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
        place = path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS[kind]}) USING parquet OPTIONS (compression 'zstd')"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self._state['buckets']} BUCKETS LOCATION '{place}'"
        )
        return name

    def _append(self, kind: str, rows: DataFrame) -> None:
        """One file a bucket: rows dealt by digest over as many partitions as buckets lie right already."""
        rows = rows.select([c.split()[0] for c in _COLUMNS[kind].split(", ")])
        if shuffle_width(self.spark) != self._state["buckets"]:
            rows = rows.repartition(self._state["buckets"], "digest")
        rows.write.insertInto(self._table(kind))

    def _read(self, kind: str) -> DataFrame:
        return self.spark.table(self._table(kind)).filter(F.col("batch").isin(self._state["batches"]))

    def entries(self) -> DataFrame:
        """One row per digest: digest, keep_id, keep_row, batch."""
        return self._read("entries")

    def copies(self) -> DataFrame:
        """digest and group_size, the rows seen with it in all batches; no shuffle."""
        return self._read("sightings").groupBy("digest").agg(F.sum("copies").alias("group_size"))

    def fresh(self, rows: DataFrame) -> DataFrame:
        """Of rows of the columns digest, keep_id and so on those whose digest has no entry, by a sort-merge anti-join."""
        return rows.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, rows: DataFrame) -> int:
        """Enter a batch of :func:`digest_rows`; returns its number, under which ``entries`` has what was new.

        Of equal digests in the batch the row with the largest key stays, of equal keys any one; null keys come last.
        """
        batch = uuid.uuid4().int >> 66
        key = F.coalesce("key", F.lit(_LEAST))
        seen = rows.groupBy("digest").agg(F.max("key").alias("keep_id"), F.max_by("row", key).alias("keep_row"), F.count("*").alias("copies"))
        self._append("sightings", seen.withColumn("batch", F.lit(batch)))
        written = self.spark.table(self._table("sightings")).filter(F.col("batch") == batch)
        self._append("entries", self.fresh(written))
        self._state["batches"].append(batch)
        self._save()
        return batch

    def compact(self) -> None:
        """Rewrite the tables with one sorted file a bucket and one sighting a digest; batches that do not count go.

        Readers of the state before still find its files.
        """
        entries, sightings = self._read("entries"), self._read("sightings")
        merged = sightings.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("keep_row").alias("keep_row"), F.sum("copies").alias("copies"), F.max("batch").alias("batch"))
        self._state["version"] += 1
        self._append("entries", entries)
        self._append("sightings", merged)
        self._save()

    def resolve(self, rows: DataFrame) -> DataFrame:
        """Per row of ``rows`` (key, digest, row, batch): key, keep_id, group_size, kept, digest.

        Hot texts are joined where their rows lie, with a broadcast of at most ``HOT_SHARE`` digests per shuffle
        partition, since no more can have so many copies; the others are dealt by digest to the buckets.
        """
        known = self.entries().withColumnRenamed("batch", "entered").join(self.copies().hint("merge"), "digest")
        total = self.copies().agg(F.sum("group_size")).first()[0] or 0
        hot = settle(known.filter(F.col("group_size") > total // (HOT_SHARE * shuffle_width(self.spark))), "digest-hot")
        names = ["key", "keep_id", "group_size", "kept", "digest"]
        kept = (F.col("batch") == F.col("entered")) & (F.col("row") == F.col("keep_row"))
        here = rows.join(F.broadcast(hot), "digest").withColumn("kept", kept).select(names)
        rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
        return here.unionByName(rest.join(known.hint("merge"), "digest").withColumn("kept", kept).select(names))


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", home: str | None = None) -> DataFrame:
    """Per row: key, keep_id (largest key of the equal texts), group_size, kept and text_sha256.

    The table enters a new index (in ``home``, else in the shared folder) in two batches, the larger keys first,
    so that what the index holds already is what stays. Texts are equal when identical; null counts as empty.
    Rows without a key come last: their keep_id is null where no copy has a key. Exactly one row of equal texts is
    kept, also where rows are repeated with their key. Very long texts are digested whole. An empty table gives no
    rows; other columns are not used, whatever their names.
    """
    spark = docs.sparkSession
    rows = digest_rows(docs, key, text)
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    upper = F.coalesce(F.col("key") > F.lit(low if low is None else low + (high - low) // 2), F.lit(False))
    index = DigestIndex.open(spark, home or shared_dir(spark, "digest-index"))
    first = index.add(rows.filter(upper))
    second = index.add(rows.filter(~upper))
    found = index.resolve(rows.withColumn("batch", F.when(upper, first).otherwise(second)))
    return found.select(F.col("key").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
