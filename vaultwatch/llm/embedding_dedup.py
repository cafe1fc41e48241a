"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by its nearest reference points, in order of nearness. Inverted lists hold, for each pivot
and label, the vectors that name it; two vectors of one list are candidates if they share enough pivots, and are
verified by their cosine in double precision.

Pivots are drawn from the vectors, so a large group of near copies would draw many, which name its members in an
order made by noise. Pivots closer than twice the angle of a link are therefore one. A vector also names no pivot
further off than its nearest by more than twice that angle: the nearest pivot of all that it links to is not beyond.
If all within that reach are named, its list is whole, one shared pivot is enough, and none of its links is missed.

A list is compared inside tasks, block against block of bounded size, so that a long list becomes many tasks and
no pair leaves a task: what leaves are each vector's number of links and a forest of links. A pair that meets in
several lists counts in that of the smallest pivot it shares. Equal vectors of a label are one class with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import components, settle

NEAREST = 8  # pivots that describe a vector
SHARED = 2  # pivots that candidates have in common
LEAST_PIVOTS, MOST_PIVOTS = 48, 8192
BLOCK = 1024


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def usable(embedding: str) -> F.Column:
    """Neither null nor empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def _apart(points: np.ndarray, limit: float) -> np.ndarray:
    """The points without those closer to an earlier one that stays than twice the angle of ``limit``, or 60 degrees."""
    near = max(0.5, 2 * limit * limit - 1) if limit > 0 else 0.5
    kept, n = np.empty_like(points), 0
    for point in points:
        if not n or (kept[:n] @ point).max() < near:
            kept[n] = point
            n += 1
    return kept[:n]


def pivots(vectors: DataFrame, count: int, limit: float) -> dict[int, np.ndarray]:
    """Reference points for each number of dimensions: vectors chosen by their hash, ``MOST_PIVOTS`` at most, apart."""
    place = F.pmod(F.xxhash64("embedding"), F.lit(1 << 40)) / float(1 << 40)
    total = vectors.count()
    chosen = vectors.select("embedding", place.alias("place")).filter(F.col("place") < 3.0 * count / max(1, total))
    rows = chosen.orderBy("place", "embedding").limit(count).collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(len(r.embedding), []).append(r.embedding)
    return {size: _apart(_unit(pa.array(v, pa.list_(pa.float64()))), limit) for size, v in found.items()}


def _described(classes: DataFrame, points: dict[int, np.ndarray], nearest: int, limit: float) -> DataFrame:
    """The classes with ``near``, their nearest pivots within reach, and ``sure``, whether these are all within reach.
    A size that has no pivots has one list, pivot -1."""
    reach = 2 * float(np.arccos(np.clip(limit, -1, 1))) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(e) for e in batch.column("embedding")])
            near: list = [None] * batch.num_rows
            sure = np.ones(batch.num_rows, bool)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                known = points.get(int(size))
                if known is None:
                    for i in rows:
                        near[i] = [-1]
                    continue
                likeness = _unit(batch.column("embedding").take(pa.array(rows))) @ known.T
                k = min(nearest, len(known))
                first = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
                least = np.cos(np.minimum(np.arccos(np.clip(likeness.max(axis=1), -1, 1)) + reach, np.pi))[:, None] - 1e-9
                within = np.take_along_axis(likeness, first, axis=1) >= least
                sure[rows] = (likeness >= least).sum(axis=1) <= k
                for i, names, inside in zip(rows, first, within):
                    near[i] = names[inside].tolist()
            yield pa.record_batch([*batch.columns, pa.array(near, pa.list_(pa.int32())), pa.array(sure)], names=[*batch.schema.names, "near", "sure"])

    return classes.mapInArrow(run, "node long, label long, weight long, embedding array<double>, near array<int>, sure boolean")


def compare(x: dict, y: dict | None, pivot: int, shared: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of two blocks of one list (``y`` None: within ``x``): what each side's vectors link to by weight, and
    the linked places. A pair counts if this is the smallest pivot that it shares; one is enough if a side is sure."""
    own = y is None
    y = x if own else y
    names = np.unique(np.concatenate([x["near"], y["near"]]))

    def marks(side: dict) -> np.ndarray:
        out = np.zeros((len(side["named"]), len(names)), np.float32)
        out[np.repeat(np.arange(len(side["named"])), side["named"]), np.searchsorted(names, side["near"])] = 1
        return out

    a, b = marks(x), marks(y)
    below = names < pivot
    enough = np.where(x["sure"][:, None] | y["sure"], 1, shared)
    linked = (x["unit"] @ y["unit"].T >= limit) & (a @ b.T >= enough) & (a[:, below] @ b[:, below].T == 0)
    if own:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    return linked @ y["weight"], np.zeros(0) if own else x["weight"] @ linked, i, j


def _compared(described: DataFrame, shared: int, limit: float, block: int) -> DataFrame:
    """Rows (a, b, n): that ``b`` has n more links; or, with n null, that a and b are linked."""
    lists = described.select("node", "label", "weight", "embedding", "near", "sure", F.explode("near").alias("pivot"), F.size("embedding").alias("size"))
    sizes = lists.groupBy("label", "pivot", "size").agg(F.count("*").alias("n"))
    sizes = settle(sizes.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "pivot-lists").drop("n")
    key = ["label", "pivot", "size"]
    placed = lists.join(sizes, key).withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # Block i meets block j, i <= j, in the task (i, j).
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "mine").alias("i"), F.greatest(o, "mine").alias("j")))
    dealt = placed.withColumn("meet", F.explode(meets)).select(*key, "meet.i", "meet.j", "mine", "node", "weight", "embedding", "near", "sure")

    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        pivot, first, second = (batch.column(c)[0].as_py() for c in ("pivot", "i", "j"))
        mine = batch.column("mine").to_numpy()

        def side(number: int) -> dict:
            rows = batch.take(pa.array(np.flatnonzero(mine == number)))
            near = rows.column("near").flatten().to_numpy().astype(np.int64)
            named = np.array([len(n) for n in rows.column("near")], np.int64)
            sure = rows.column("sure").to_numpy(zero_copy_only=False).astype(bool)
            return {"node": rows.column("node").to_numpy(), "weight": rows.column("weight").to_numpy().astype(float), "near": near, "named": named, "sure": sure, "unit": _unit(rows.column("embedding")) if rows.num_rows else np.zeros((0, 1))}

        x = side(first)
        y = side(second) if second != first else None
        if not len(x["node"]) or y is not None and not len(y["node"]):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        to_x, to_y, i, j = compare(x, y, pivot, shared, limit)
        other = x if y is None else y
        nodes = np.concatenate([x["node"], other["node"]] if y is not None else [x["node"]])
        counts = np.concatenate([to_x, to_y]).astype(np.int64)
        some = counts > 0
        # A forest is enough for the components.
        a, b = _forest(x["node"][i], other["node"][j])
        return pa.table(
            {
                "a": pa.array(np.concatenate([np.zeros(some.sum(), np.int64), a])),
                "b": pa.array(np.concatenate([nodes[some], b])),
                "n": pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(a), pa.int64())]),
            }
        )

    return dealt.groupBy(*key, "i", "j").applyInArrow(run, "a long, b long, n long")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each node of the links one link to the smallest node that it reaches by them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, side, low)
            np.minimum.at(root, before[side], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[moved]], nodes[moved]


def link(vectors: DataFrame, limit: float = 0.93, nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id and kept (vec_id = component_id).

    Vectors are compared only within a label and a number of dimensions. A null label, and an embedding that is
    null, empty, zero or holds null or non-finite components, links with nothing. Rows with equal embeddings are
    linked; rows of one vec_id count each. Other columns are not used; an empty table gives no rows.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    able = usable("embedding") & F.col("label").isNotNull()
    rows = settle(rows.select("*", F.when(able, F.col("embedding")).alias("class"), F.when(able, F.xxhash64("embedding")).alias("h")), "vectors")
    grouped = rows.filter("class IS NOT NULL").groupBy("label", F.col("class").alias("embedding")).agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = settle(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    count = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 2 * classes.count() ** 0.5)))
    described = settle(_described(classes.select("node", "label", "weight", "embedding"), pivots(classes, count, limit), nearest, limit), "vector-pivots")
    found = settle(_compared(described, shared, limit, block), "vector-links")
    links = found.filter("n IS NOT NULL").groupBy(F.col("b").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(found.filter("n IS NULL").select("a", "b"), "vector-components")
    named = classes.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(smallest, "root").select("label", F.col("embedding").alias("class"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component")
    placed = rows.select("vec_id", "label", "class").join(settle(named, "vector-named"), ["label", "class"], "left")
    component = F.coalesce("component", "vec_id")
    return placed.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
