"""Ranked lexical search: the best documents of each item, by norm buckets of impact vectors.

A document is the vector of its terms' impacts, an item that of its terms' weights, and a score their product. Only
terms of items have coordinates, as all others meet no weight.

Buckets. Vectors lie in falling order of length and are cut to buckets of like length. With an item's present
threshold (the score its last place needs) a bucket goes unread if the length of its longest vector times that of
the item stays below (Cauchy-Schwarz). Inside, the item's heaviest coordinates are summed from the bucket's inverted
lists, and the inequality bounds what the other coordinates can add, given what is left of both lengths. What may
still reach the threshold is scored exactly in integers from its own vector.

Thresholds. The longest vectors of all partitions, a small share, are searched first; the score of an item's last
place there is where all tasks begin with the rest, and each raises it as it goes. No result depends on it.

Items come in blocks of bounded text, by which the vocabulary and the thresholds that tasks share are bounded.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultwatch.llm.common import ALNUM, LOWER, pieces, settle

PLACES = 50
BLOCK_BYTES = 16 << 20
BUCKET_DOCS = 4_096
BUCKET_RATIO = 0.9  # a bucket ends where a vector is shorter than this part of its longest
HEAD = 1 / 64  # share of the longest vectors that is searched first
FOCUS = (1, 4, 12, 28)  # how many of the heaviest coordinates are summed before each bound
_SLACK = 1 + 1e-9  # bounds are in doubles
_CHUNK = 1 << 20
_TERMS = bytes(int(LOWER[b]) if ALNUM[b] else 0x20 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in runs of about a megabyte of text each."""
    clean = text.translate(_TERMS)
    start = 0
    while start < len(clean):
        end = len(clean) if len(clean) - start <= _CHUNK else clean.find(b" ", start + _CHUNK)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Per row with a term: key, n (all its terms), terms (places in the vocabulary, rising) and times."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for batch in batches:
            for part in pieces(batch, "text"):
                sizes, terms, times = [], [], []
                for body in part.column("text").to_pylist():
                    n, known = 0, []
                    for words in _words(body or b""):
                        n += len(words)
                        known.append(np.array([i for i in map(place, words) if i is not None], np.uint32))
                    found, count = np.unique(np.concatenate(known) if known else np.empty(0, np.uint32), return_counts=True)
                    sizes.append(n)
                    terms.append(found.tobytes())
                    times.append(count.astype(np.uint32).tobytes())
                out = pa.record_batch([part.column("key"), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())], names=["key", "n", "terms", "times"])
                yield out.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("binary").alias("text"))
    return rows.mapInArrow(run, "key long, n long, terms binary, times binary")


def statistics(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and in how many documents each term of the vocabulary is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        rows = total = 0
        for batch in batches:
            rows += batch.num_rows
            total += int(batch.column("n").to_numpy().sum())
            held += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.uint32), minlength=size)
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.concatenate([used, [-1, -2]])), pa.array(np.concatenate([held[used], [rows, total]]))], names=["cell", "v"])

    found = vectors.select("n", "terms").mapInArrow(run, "cell long, v long").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    cells, values = found["cell"].to_numpy(), found["v"].to_numpy()
    held = np.zeros(size, np.int64)
    held[cells[cells >= 0]] = values[cells >= 0]
    sums = dict(zip(cells.tolist(), values.tolist()))
    return sums.get(-1, 0), sums.get(-2, 0), held


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all rows, and how many each row has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint32), np.array([len(v) // 4 for v in values], np.int64)


def impact_vectors(vectors: DataFrame, documents: int, total: int) -> DataFrame:
    """key, terms, impacts and length of each vector with a coordinate, in falling length within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, counts = _flat(batch.column("times"))
            # Python's integers, as n times the number of documents may be beyond 64 bits
            m = np.array([100 - 50 + 50 * n * documents // total for n in batch.column("n").to_pylist()], np.int64)
            tf = times.astype(np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, counts))
            ends = np.cumsum(counts)
            length = np.sqrt(np.bincount(np.repeat(np.arange(len(counts)), counts), weights=impact.astype(float) ** 2, minlength=len(counts)))
            packed = impact.astype(np.uint32)
            rows = [packed[e - c : e].tobytes() for e, c in zip(ends, counts)]
            out = pa.record_batch([batch.column("key"), batch.column("terms"), pa.array(rows, pa.binary()), pa.array(length)], names=["key", "terms", "impacts", "length"])
            yield out.filter(pa.array(length > 0))

    made = vectors.mapInArrow(run, "key long, terms binary, impacts binary, length double")
    return made.sortWithinPartitions(F.desc("length"))


class Items:
    """A block of items as weight vectors, heaviest coordinates first, and the thresholds to begin with."""

    def __init__(self, ids: list, terms: list[np.ndarray], weight: np.ndarray):
        self.ids, self.terms, self.weights, self.rest = ids, [], [], []
        for t in terms:
            order = t[np.lexsort([t, -weight[t]])]
            w = weight[order]
            self.terms.append(order)
            self.weights.append(w)
            # The length of what is left after the first coordinates.
            self.rest.append(np.sqrt(np.append(np.cumsum(w[::-1].astype(float) ** 2)[::-1], 0.0)))
        self.size = len(weight)
        self.least = np.ones(len(ids), np.int64)


class _Bucket:
    """Vectors of like length, with an inverted list of each coordinate."""

    def __init__(self, keys: np.ndarray, null: np.ndarray, terms: np.ndarray, impacts: np.ndarray, counts: np.ndarray, length: np.ndarray):
        self.keys, self.null, self.terms, self.impacts, self.counts = keys, null, terms, impacts.astype(np.int64), counts
        self.starts = np.cumsum(counts) - counts
        self.square, self.longest = length**2, float(length.max())
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(counts)), counts)[order]
        self.listed = self.impacts[order].astype(float)
        self.values, begins = np.unique(terms[order], return_index=True)
        self.bounds = np.append(begins, len(terms))

    def _lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the inverted lists of these terms, and of which term each is."""
        at = np.minimum(np.searchsorted(self.values, terms), len(self.values) - 1)
        there = np.flatnonzero(self.values[at] == terms)
        begin, end = self.bounds[at[there]], self.bounds[at[there] + 1]
        sizes = end - begin
        places = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        return places, np.repeat(there, sizes)

    def candidates(self, terms: np.ndarray, weights: np.ndarray, rest: np.ndarray, least: int) -> np.ndarray:
        """Rows that the bounds leave, by more and more of the item's coordinates."""
        size = len(self.counts)
        summed, used, done = np.zeros(size), np.zeros(size), 0
        alive = np.ones(size, bool)
        for upto in FOCUS:
            if done == len(terms):
                break
            upto = min(upto, len(terms))
            places, of = self._lists(terms[done:upto])
            rows, impact = self.rows[places], self.listed[places]
            summed += np.bincount(rows, weights=impact * weights[done:upto][of], minlength=size)
            used += np.bincount(rows, weights=impact**2, minlength=size)
            done = upto
            alive &= (summed + rest[done] * np.sqrt(np.maximum(self.square * _SLACK - used, 0))) * _SLACK >= least
            if 32 * alive.sum() < size:
                break
        return np.flatnonzero(alive)

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        counts = self.counts[rows]
        places = np.arange(counts.sum()) + np.repeat(self.starts[rows] - (np.cumsum(counts) - counts), counts)
        return np.add.reduceat(weight[self.terms[places]] * self.impacts[places], np.cumsum(counts) - counts)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[_Bucket]:
    for batch in batches:
        length = batch.column("length").to_numpy()
        start = 0
        while start < len(length):
            short = np.flatnonzero(length[start : start + BUCKET_DOCS] < BUCKET_RATIO * length[start])
            end = min(start + BUCKET_DOCS, len(length), start + max(int(short[0]), min(BUCKET_DOCS // 16, len(length) - start)) if len(short) else len(length))
            part = batch.slice(start, end - start)
            terms, counts = _flat(part.column("terms"))
            impacts, _ = _flat(part.column("impacts"))
            key = part.column("key")
            yield _Bucket(key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), terms.astype(np.int64), impacts, counts, length[start:end])
            start = end


def search(vectors: DataFrame, items: Items, places: int) -> DataFrame:
    """Per task and item the best rows: item (place in the block), key, score. A superset of the best of all."""
    shared = vectors.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        least = block.least.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        weight = np.zeros(block.size, np.int64)
        item_length = np.array([r[0] for r in block.rest])
        for bucket in _buckets(batches):
            for i in np.flatnonzero(item_length * bucket.longest * _SLACK >= least):
                terms, weights = block.terms[i], block.weights[i]
                rows = bucket.candidates(terms, weights, block.rest[i], int(least[i]))
                if not len(rows):
                    continue
                weight[terms] = weights
                score = bucket.scores(rows, weight)
                weight[terms] = 0
                enough = score >= least[i]
                rows, score = rows[enough], score[enough]
                if not len(rows):
                    continue
                key, null = bucket.keys[rows], bucket.null[rows]
                if i in best:
                    key, null, score = (np.concatenate([a, b]) for a, b in zip(best[i], (key, null, score)))
                order = np.lexsort([key, null, -score])[:places]
                best[i] = key[order], null[order], score[order]
                if len(order) == places:
                    least[i] = max(least[i], score[order[-1]])
        for i, (key, null, score) in best.items():
            yield pa.record_batch([pa.array(np.full(len(key), i, np.int32)), pa.array(key, pa.int64(), mask=null), pa.array(score)], names=["item", "key", "score"])

    return vectors.select("key", "terms", "impacts", "length").mapInArrow(run, "item int, key long, score long")


def _top(found: DataFrame, by: str, places: int) -> DataFrame:
    """The best of each item with their rank; each task's rows are cut before an item is gathered."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= places)


def _block(items: list, vocabulary: dict[bytes, int]) -> tuple[list, list[np.ndarray]]:
    """The items of a block, and the vocabulary's places of their terms; fills the vocabulary."""
    terms: dict = defaultdict(set)
    for item, text in items:
        for words in _words(bytes(text or b"")):
            terms[item].update(vocabulary.setdefault(w, len(vocabulary)) for w in words)
    ids = [i for i in terms if terms[i]]
    return ids, [np.array(sorted(terms[i]), np.int64) for i in ids]


def rank(docs: DataFrame, items: DataFrame, places: int = PLACES, key: str = "doc_id", text: str = "text", item: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item and place: item, rank (from 1), key, score, of the documents with a score above zero.

    Equal scores are in ascending order of the key, null keys last. A null or empty text, or one without letters and
    digits, has no terms: such an item has no rows, such a document no score. Rows of one item id (null is an id
    too) are one item with the terms of all its texts; rows of one document key are documents of their own. Texts
    are read whole, very long ones in runs. Without documents or items there are no rows. Other columns are not
    used. Each block of items reads the documents once.
    """
    spark = docs.sparkSession
    wanted = settle(items.select(items[item].alias("item"), items[text].cast("binary").alias("text")).distinct(), "search-items")
    total_bytes = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total_bytes // block_bytes)
    schema = f"`{item}` {dict(wanted.dtypes)['item']}, rank int, `{key}` long, score long"
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        vocabulary: dict[bytes, int] = {}
        ids, terms = _block([tuple(r) for r in wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()], vocabulary)
        if ids:
            names = spark.createDataFrame([(i, name) for i, name in enumerate(ids)], f"item int, name {dict(wanted.dtypes)['item']}")
            best = _ranked(docs, Items(ids, terms, np.zeros(len(vocabulary), np.int64)), vocabulary, places, key, text)
            named = best.join(F.broadcast(names), "item").select(F.col("name").alias(item), "rank", F.col("key").alias(key), "score")
            found = named if block == 0 else found.unionByName(settle(named, "search-found"))
    return found


def _ranked(docs: DataFrame, items: Items, vocabulary: dict[bytes, int], places: int, key: str, text: str) -> DataFrame:
    size = len(vocabulary)
    vectors = settle(term_vectors(docs, vocabulary, key, text), "search-terms")
    documents, total, held = statistics(vectors, size)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)
    items = Items(items.ids, items.terms, weight)
    ordered = settle(impact_vectors(vectors, documents, max(total, 1)), "search-impacts")
    cut = ordered.agg(F.percentile_approx("length", F.lit(1 - HEAD))).first()[0]
    if cut is None:
        return docs.sparkSession.createDataFrame([], "item int, key long, score long, rank int")
    head = settle(search(ordered.filter(F.col("length") >= cut), items, places), "search-head")
    for i, score in _top(head, "item", places).filter(F.col("rank") == places).select("item", "score").collect():
        items.least[i] = max(1, score)
    rest = search(ordered.filter(F.col("length") < cut), items, places)
    return _top(head.unionByName(rest), "item", places)
