"""Event and result topics: Kafka records, or a folder of JSON files with the same content."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwatch.schemas import EVENT_SCHEMA, EVENT_TOPIC


def encode(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """One JSON text per row, declared fields only and in their order, nulls written out."""
    fields = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return rows.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def decode(records: DataFrame, schema: T.StructType, mode: str = "FAILFAST", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text back to columns, after those to ``keep``. A corrupt record ends the job, unless ``mode`` is PERMISSIVE.

    ``inline`` keeps the parser to one call per record: a struct column would be parsed again by
    every filter that is moved below its projection.
    """
    return records.select(*keep, F.inline(F.array(F.from_json(F.col("value").cast("string"), schema, {"mode": mode}))))


def decode_with_rejects(records: DataFrame, schema: T.StructType) -> DataFrame:
    """As :func:`decode`, with the text of a corrupt record in ``corrupt``, null for sound ones."""
    wide = T.StructType([*schema.fields, T.StructField("corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    return records.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), wide, options))))


def kafka_reader_options(servers: str, topics: str | list[str], start: str = "latest", group: str | None = None) -> dict[str, str]:
    """``start`` holds for the first run only; later runs go on from the checkpoint."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start!r}")
    names = [topics] if isinstance(topics, str) else topics
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(names), "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_writer_options(servers: str, topic: str | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers} | ({"topic": topic} if topic else {})


def kafka_events(
    spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, start: str = "latest", group: str | None = None, records_per_batch: int | None = None
) -> DataFrame:
    """Events of a topic; ``seq``, their arrival, is the partition and the offset in it."""
    options = kafka_reader_options(servers, topic, start, group) | ({"maxOffsetsPerTrigger": str(records_per_batch)} if records_per_batch else {})
    records = spark.readStream.format("kafka").options(**options).load()
    return decode(records.withColumn("seq", F.struct("partition", "offset")), EVENT_SCHEMA, keep=("seq",))


def arrival(row: Column | None = None) -> Column:
    """The place of a row of files: file, block and the row within the block.

    Rows of a block are read in order by one task, so the last, which only has to rise there, is the task's own
    count. Streams cannot count: give them ``_metadata.row_index`` for Parquet. Other streams know the block only
    (``row`` a constant); rows of a block are then in the order of their labels.
    """
    row = F.monotonically_increasing_id() if row is None else row
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("row"))


def stream_arrival() -> Column:
    return arrival(F.lit(0).cast("long"))


def parquet_events(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Event stream over a folder of Parquet files, such as :func:`publish_in_order` makes, with ``seq``, their arrival."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(path)
    return events if "seq" in schema.fieldNames() else events.withColumn("seq", arrival(F.col("_metadata.row_index")))


def file_events(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    schema: T.StructType = EVENT_SCHEMA,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Event stream over a folder of JSON lines, with ``seq``, their arrival.

    ``files_per_batch`` bounds a batch and sets the replay's pace. Files come in the order in which they were written:
    see :func:`publish_in_order`, or give the query a lateness.
    """
    reader = spark.readStream.schema(schema).option("mode", mode)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn("seq", stream_arrival())


def publish_in_order(
    events: DataFrame, path: str, batches: int, ts: str = "ts", rows_per_file: int = 5_000_000, fmt: str = "parquet", rows_per_task: int = 250_000
) -> int:
    """Add a table to a file topic in order of time, in one write.

    The rows are dealt by ranges of time, and then of a hash, so that one instant may hold any share of them, and each
    task writes its range in order. A batch has as many ranges as its rows ask for, ``rows_per_task`` each, so that
    larger tables are written, and each batch read, by more tasks. Files are then moved to the topic one after the other, with rising times, which
    is the order that streams read in. No file holds rows before those of a file read earlier, so no row comes late,
    whatever a batch reads. Returns how many files a batch should read for about ``batches`` of them.
    """
    spark = events.sparkSession
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    spread = F.xxhash64(*events.columns)
    ranges = batches * max(1, -(-events.count() // (batches * rows_per_task)))
    dealt = events.withColumn("_spread", spread).repartitionByRange(ranges, ts, "_spread").sortWithinPartitions(ts).drop("_spread")
    dealt.write.option("maxRecordsPerFile", rows_per_file).format(fmt).save(staging)
    return max(1, -(-move_in_order(spark, staging, path) // batches))


def move_in_order(spark: SparkSession, staging: str, path: str) -> int:
    """Move the files of a finished write, by name, to a topic's folder behind those that are there; returns their number.

    Streams read files in order of their times, so each gets a later one than the file before it. A file system that
    does not keep the times is an error, since a stream would read files of it in another order.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path
    source, target = folder(staging), folder(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    written = sorted(s.getPath().getName() for s in files.listStatus(source) if s.getPath().getName().startswith("part-"))
    there = [s.getModificationTime() for s in files.listStatus(target) if s.isFile()]
    last = max([int(time.time() * 1000) - len(written), *there])
    for name in written:
        last += 1
        moved = folder(target, name)
        files.setTimes(folder(source, name), last, -1)
        if not files.rename(folder(source, name), moved) or files.getFileStatus(moved).getModificationTime() < last:
            raise RuntimeError(f"cannot keep the order of files in {path}")
    files.delete(source, True)
    return len(written)


def publish(events: DataFrame, path: str, schema: T.StructType = EVENT_SCHEMA, mode: str = "append") -> None:
    """Add events to a file topic."""
    encode(events, schema).write.mode(mode).text(path)
