"""What the operators share: settled tables, texts as byte arrays, word hashes, linked components."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwatch.sources.shared import shared_dir

U64 = np.uint64
# ASCII white space: blank and the range from tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: computed once, safe from lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Lower the session's bound on the bytes of a batch that goes to a Python worker, where it is above ``limit``.

    A batch is in memory several times, in the JVM and in each worker, whatever pieces the operators take it in.
    """
    size = spark.conf.get(_BATCH_BYTES).lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if int(size.rstrip("kmg")) * units.get(size[-1:], 1) > limit or int(size.rstrip("kmg")) <= 0:
        spark.conf.set(_BATCH_BYTES, limit)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory that the allocators of this process keep."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function of a task that gives freed memory back at its end: a worker goes on with tasks of other kinds, and
    what its allocators keep would add up beside them."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def batches_of(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``rows`` rows, so that a task holds few texts at once."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes; one longer text is a run of its own."""
    sizes = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))
    run = (np.cumsum(sizes) // limit).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of the column as one UTF-8 byte array and the offsets of each; a null is an empty text."""
    filled = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(filled.type) or pa.types.is_large_binary(filled.type)
    dtype = np.int64 if wide else np.int32
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, dtype=dtype)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


_STEP = U64(0x9E3779B97F4A7C15)
_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * _STEP)
# Bytes of words without signs: letters, digits and what is beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
IS_SPACE = np.isin(np.arange(256), SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


_POWERS: dict[str, np.ndarray] = {}
_POWERS_KEPT = (1 << 21) + (1 << 16)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd step modulo 2**64, and of its inverse. The worker keeps so many as usual batches need; those
    for a very long text go with it."""
    if n > len(_POWERS.get("up", ())):
        size = max(n, 1 << 16)
        inverse = U64(pow(int(_STEP), -1, 1 << 64))
        up, down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, step)])) for step in (_STEP, inverse))
        if size > _POWERS_KEPT:
            return up, down
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"], _POWERS["down"]


def hash_table(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a polynomial over byte values, and the factors that take a span's begin out of it:
    ``(sums[end] - sums[begin]) * factors[begin]`` depends on the bytes of the span alone."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(_BYTE_VALUE[values] * up[: len(values)], out=sums[1:])
    return sums, down


# Powers modulo 2**64 give strings of some shapes (Thue-Morse words) one sum, from a few hundred bytes on.
LONG_SPAN = 256


def hash_spans(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, long_span: int | None = LONG_SPAN) -> np.ndarray:
    """A 64-bit hash of each span of byte values; of spans longer than ``long_span`` a digest."""
    sums, down = hash_table(values)
    found = mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(U64))
    for i in np.flatnonzero(ends - begins > long_span) if long_span else ():
        found[i] = int.from_bytes(hashlib.blake2b(values[begins[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found


def word_spans(raw: np.ndarray, at: np.ndarray, word_bytes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word: parted by ASCII white space, or made of the bytes marked in ``word_bytes``."""
    solid = ~IS_SPACE[raw] if word_bytes is None else word_bytes[raw]
    begins, ends = solid.copy(), solid.copy()
    cut = ~(solid[1:] & solid[:-1])
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
    cut[inner - 1] = True
    begins[1:] &= cut
    ends[:-1] &= cut
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(raw: np.ndarray, at: np.ndarray, word_bytes: np.ndarray | None = None, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased) of :func:`word_spans`, or of its first ``upto`` bytes, and the text
    it is of."""
    starts, stops = word_spans(raw, at, word_bytes)
    if not len(starts):
        return np.empty(0, U64), np.empty(0, np.int64)
    h = hash_spans(LOWER[raw], starts, stops if upto is None else np.minimum(stops, starts + upto))
    return h, np.searchsorted(at, starts, side="right") - 1


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words.

    A text of fewer words has one run, of all of them; a text without words has none.
    """
    h, owner = words(raw, at)
    texts = len(at) - 1
    counts = np.bincount(owner, minlength=texts)
    ends = np.cumsum(counts)
    total = np.zeros(len(h), U64)
    runs: dict[int, np.ndarray] = {}
    for n in range(1, width + 1):
        moved = np.zeros(len(h), U64)
        moved[: max(0, len(h) - n + 1)] = h[n - 1 :] if n > 1 else h
        total = mix(total * _STEP + moved + U64(n))
        runs[n] = total
    for i in range(texts):
        n, start = int(counts[i]), int(ends[i] - counts[i])
        if n == 0:
            yield np.empty(0, U64)
        elif n < width:
            yield runs[n][start : start + 1]
        else:
            found = np.sort(runs[width][start : start + n - width + 1])
            yield found[np.append(True, found[1:] != found[:-1])]


def binary_column(chunks: list[np.ndarray]) -> pa.Array:
    return pa.array([c.tobytes() for c in chunks], pa.binary())


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, U64).view(np.int64))


FILTER_BITS = 23


def bit_filter(keys: DataFrame) -> np.ndarray:
    """A bit table of fixed size with a bit for each value of the column ``h`` (long, evenly spread).

    What has no bit is surely not among the keys; a join decides on the rest. It saves shuffles of what is known
    to be of no use, the less the more keys there are, and never changes a result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[batch.column("h").to_numpy().view(U64) >> U64(64 - FILTER_BITS)] = True
        packed = np.packbits(bits)
        used = np.flatnonzero(packed)
        yield pa.record_batch({"at": pa.array(used), "bits": pa.array(packed[used].astype(np.int32))})

    found = keys.select("h").mapInArrow(run, "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return table


def may_hold(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h.view(U64) >> U64(64 - FILTER_BITS)).astype(np.int64)
    return table[at >> 3] >> (7 - (at & 7)) & 1 > 0


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task reduced to one link from each node to the smallest node it reaches there."""
    for batch in batches:
        nodes, pair = np.unique(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), return_inverse=True)
        a, b = pair.reshape(2, -1)
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            root = root[root]
            if np.array_equal(before, root):
                break
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.record_batch({"a": nodes[root[moved]], "b": nodes[moved]})


def components(links: DataFrame, purpose: str) -> DataFrame:
    """Columns ``node`` and ``root`` for every node of the links (``a``, ``b``: long) but the roots themselves.

    The root is the smallest node reachable. In each round every node follows its smallest neighbour, the
    chains are halved until they are flat, and the links are drawn anew between the roots. Each round at
    least halves the nodes; every table goes to the shared folder, none to the driver.
    """
    found: list[DataFrame] = []
    proper = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    live = proper.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    live = settle(live.mapInArrow(_forest, "a long, b long").distinct(), purpose)
    while not live.isEmpty():
        up = settle(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), purpose)
        while True:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            up = settle(up.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), purpose)
            if up.filter("moved").isEmpty():
                break
        up = up.drop("moved")
        found.append(up)
        a = live.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        ab = a.join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        ends = ab.select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")).filter("x <> y")
        live = settle(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), purpose)
    if not found:
        return links.sparkSession.createDataFrame([], "node long, root long")
    labels = found[-1]
    for up in reversed(found[:-1]):
        over = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = labels.unionByName(up.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    return settle(labels, purpose)
