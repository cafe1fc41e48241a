"""Near-duplicate documents by bottom-k sketches of word shingles, confirmed on the full sets.

One hash function orders all shingles; a sketch is the k smallest of a document. Documents of equal sets are one
class. Inverted lists of retained values generate the overlaps of classes, the sketch of the union estimates their
similarity, and what may reach the limit is compared on the full sets.

Lists. Two sets of similarity s share at least ``need`` retained values, but for a chance below ``MISS``: each
value among the k smallest of the union is in both with probability s. In a common order (rare values first) they
then share one of the first k - need + 1, so only those are listed; what most documents have comes last. The
order is by counts of the values in a table of fixed size, which decides only the work, never the result.

Links. First each class is compared with one other, the most like it by estimate of those that a hash draws from its
lists, on the words of both texts. Lists whose members are then of several components are mixed, and all their pairs
across components count. These are never rows: lists with the same first member are a crowd, which has each member
once, in blocks where it is large. Tasks first count the fingerprints of retained values that members of a block
share, and name those with a partner that may reach the limit. These come again with a sketch wide enough to hold most
sets in full; a task compares them by one matrix product and gives back a forest of links, at most one a member. Only
pairs with a set beyond the wide sketch leave it as pairs, if the wide sketches say that they may reach the limit and
the links of the task have not joined them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import LOWER, U64, binary_column, bit_filter, components, lean, may_hold, mix, pieces, settle, shingle_sets, signed, text_bytes

K = 64
WIDE = 512  # values of a wide sketch: sets of so many shingles are whole in it
BLOCK = 1_024  # members of a part of a crowd; a block has two parts
PAIRS = 2_048  # pairs of wide sketches estimated at once
_SMALL = 96  # members of a block whose pairs are found together with those of other blocks
_CELLS = 1 << 22  # of a matrix of members and shingles
MISS = 1e-7
COUNT_BITS = 20
_SALT = (U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))


def need(k: int, percent: int) -> int:
    """The most shared values out of k that a pair at the limit has but for a chance below ``MISS``."""
    p, total = percent / 100, 0.0
    for hits in range(k + 1):
        total += math.comb(k, hits) * p**hits * (1 - p) ** (k - hits)
        if total > MISS:
            return hits
    return k


def prefix(n: int, k: int, percent: int) -> int:
    """How many of the values retained of a set of ``n`` are listed."""
    if n * 100 <= k * percent:  # its partners are known in full, too
        return n - -(-n * percent // 100) + 1
    return min(n, k) - need(k, percent) + 1


def prints(values: np.ndarray) -> np.ndarray:
    return (mix(values ^ _SALT[0]) >> U64(48)).astype(np.uint16)


def sketches(docs: DataFrame, width: int, k: int, key: str, text: str) -> DataFrame:
    """Per row: key, n (size of the set), s1 and s2 (which equal sets share), sketch (k smallest hashes) and prints (a
    fingerprint of 16 bits of each of them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = list(shingle_sets(*text_bytes(part.column("text")), width))
                sums = [signed([mix(s ^ salt).sum() if len(s) else U64(0) for s in sets]) for salt in _SALT]
                yield pa.record_batch([part.column("key"), pa.array([len(s) for s in sets], pa.int64()), *sums, binary_column([s[:k] for s in sets]), binary_column([prints(s[:k]) for s in sets])], names=["key", "n", "s1", "s2", "sketch", "prints"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(lean(run), f"key {dict(rows.dtypes)['key']}, n long, s1 long, s2 long, sketch binary, prints binary")


def _values(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, U64) for v in column.to_pylist()]


def _counts(classes: DataFrame) -> np.ndarray:
    """How many retained values fall into each cell of a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for value in _values(batch.column("sketch")):
                np.add.at(total, (mix(value) >> U64(64 - COUNT_BITS)).astype(np.int64), 1)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": pa.array(cells, pa.int64()), "n": pa.array(total[cells])})

    found = classes.select("sketch").mapInArrow(lean(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << COUNT_BITS, np.int32)
    table[found["cell"].to_numpy()] = np.minimum(found["n"].to_numpy(), 2**31 - 1)
    return table


def _postings(classes: DataFrame, k: int, percent: int) -> DataFrame:
    counts = _counts(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_pylist()
            chosen = []
            for n, value in zip(sizes, _values(batch.column("sketch"))):
                order = np.lexsort([value, counts[(mix(value) >> U64(64 - COUNT_BITS)).astype(np.int64)]])
                chosen.append(value[order[: prefix(n, k, percent)]])
            times = [len(c) for c in chosen]
            yield pa.record_batch({"value": signed(np.concatenate(chosen)), "node": pa.array(np.repeat(batch.column("node").to_numpy(), times)), "n": pa.array(np.repeat(batch.column("n").to_numpy(), times))})

    return classes.select("node", "n", "sketch").mapInArrow(lean(run), "value long, node long, n long")


def _padded(values: list[np.ndarray], k: int) -> np.ndarray:
    out = np.full((len(values), k), U64(2**64 - 1))
    for row, value in zip(out, values):
        row[: len(value)] = value
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, k: int) -> np.ndarray:
    """The similarity of each row's two padded sketches by the sketch of the union; exact where both are whole sets."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = both[:, 1:] == both[:, :-1]
    real = both != np.iinfo(both.dtype).max
    new = real.copy()
    new[:, 1:] &= ~again
    limit = np.where((na <= k) & (nb <= k), 2 * k, k)[:, None]
    within = np.cumsum(new, axis=1) <= limit
    shared = (again & real[:, 1:] & within[:, 1:]).sum(axis=1)
    return shared / np.maximum((new & within).sum(axis=1), 1)


def _prints(column: pa.Array, k: int) -> np.ndarray:
    """A row of fingerprints for each value of the column, filled up with numbers that stand once in it."""
    raw = [np.frombuffer(v, np.uint16) for v in column.to_pylist()]
    out = np.tile(np.arange(1 << 16, (1 << 16) + k, dtype=np.uint32), (len(raw), 1))
    for row, value in zip(out, raw):
        row[: len(value)] = value
    return out


def alike(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, k: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many fingerprints the two rows of each pair share, chance ones included, and whether the pair may reach the limit."""
    both = np.sort(np.concatenate([a, np.where(b >= 1 << 16, b + np.uint32(1 << 16), b)], axis=1), axis=1)
    shared = (both[:, 1:] == both[:, :-1]).sum(axis=1)
    whole = -(-(na + nb) * percent // (100 + percent))
    return shared, shared >= np.where((na <= k) & (nb <= k), whole, need(k, percent))


def _best(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """For each b the a that is most like it by its fingerprints, of the pairs (a, b) that may reach the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            shared, may = alike(_prints(batch.column("pa"), k), _prints(batch.column("pb"), k), na, nb, k, percent)
            like = shared / np.maximum(np.minimum(na, k) + np.minimum(nb, k) - shared, 1)
            a, b, may = batch.column("a").to_numpy(), batch.column("b").to_numpy(), np.flatnonzero(may)
            order = may[np.lexsort([a[may], -like[may], b[may]])]
            first = order[np.append(True, b[order][1:] != b[order][:-1])] if len(order) else order
            yield pa.record_batch({"a": pa.array(a[first]), "b": pa.array(b[first]), "like": pa.array(like[first])})

    side = classes.select("node", "n", "prints")
    # The merge leaves the rows of a b side by side, so that a batch gives about one row for each.
    joined = pairs.join(side.toDF("a", "na", "pa"), "a").join(side.toDF("b", "nb", "pb").hint("merge"), "b")
    found = joined.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(lean(run), "a long, b long, like double")
    return found.groupBy("b").agg(F.max_by("a", "like").alias("a")).select("a", "b")


def _pick(nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int, text: str, wide: int | None) -> DataFrame:
    """node and the text of one document of each of these classes, or a sketch of ``wide`` values of it."""
    chosen = settle(classes.join(nodes, "node").select("node", "n", "s1", "s2", F.col("s1").alias("h")), "near-wanted")
    table = bit_filter(chosen)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = list(shingle_sets(*text_bytes(part.column("text")), width))
                sums = [np.array([mix(s ^ salt).sum() if len(s) else U64(0) for s in sets], U64) for salt in _SALT]
                maybe = pa.array(may_hold(table, sums[0]))
                what = part.column("text") if wide is None else binary_column([s[:wide] for s in sets])
                columns = [what, pa.array([len(s) for s in sets], pa.int64()), *map(signed, sums)]
                yield pa.record_batch([c.filter(maybe) for c in columns], names=["what", "n", "s1", "s2"])

    kind = "string" if wide is None else "binary"
    found = docs.select(docs[text].alias("text")).mapInArrow(lean(pick), f"what {kind}, n long, s1 long, s2 long")
    return settle(found.join(chosen.drop("h"), ["n", "s1", "s2"]).groupBy("node").agg(F.first("what").alias("what")), "near-texts")


_WORDS = bytes(LOWER)


def similar(one: str, other: str, width: int, percent: int) -> bool:
    """Whether the sets of word runs of two texts reach the limit; by the words themselves, no hash decides."""
    a, b = one.encode().translate(_WORDS).split(), other.encode().translate(_WORDS).split()
    if len(a) < width or len(b) < width:
        return a == b and len(a) > 0
    place: dict[bytes, int] = {}
    ids = np.array([place.setdefault(w, len(place)) for w in a + b])
    code = ids
    for i in range(1, width):  # one number for each distinct run so far
        code = np.unique(code[:-1] * len(place) + ids[i:], return_inverse=True)[1]
    x, y = np.unique(code[: len(a) - width + 1]), np.unique(code[len(a) :][: len(b) - width + 1])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, text: str) -> DataFrame:
    """The pairs whose full sets reach the limit, compared on one text of each class."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "ta"):
                a, b = (shingle_sets(*text_bytes(part.column(c)), width) for c in ("ta", "tb"))
                keep = []
                for x, y, one, other in zip(a, b, part.column("ta"), part.column("tb")):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    hashed = 100 * both >= percent * (len(x) + len(y) - both)
                    keep.append(hashed and similar(one.as_py(), other.as_py(), width, percent))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _pick(wanted, classes, docs, width, text, None)
    joined = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return joined.select("a", "b", "ta", "tb").mapInArrow(lean(compare), "a long, b long")


def _near(percent: int):
    """Sets whose sizes are too far apart cannot reach the limit."""
    return (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of which the ends have different roots."""
    ends = pairs.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    return ends.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _crowds(members: DataFrame, block: int) -> DataFrame:
    """Members of mixed lists, each once in a block of a crowd: crowd, i, j, node, n, root, part, values.

    A crowd is the lists of one first member. It is dealt by a hash of the node to ``parts`` parts of about ``block``
    members, and a block is a pair i, j of parts: a member is in as many blocks as there are parts.
    """
    mixed = members.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("crowd"))
    mixed = mixed.filter("low < high").select("value", "crowd")
    placed = members.join(mixed, "value").groupBy("crowd", "node", "n", "root").agg(F.collect_set("value").alias("values"))
    placed = settle(placed, "near-placed")
    sizes = placed.groupBy("crowd").agg(F.count("*").alias("size"))
    parts = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / block)))).cast("int")
    dealt = placed.join(sizes.withColumn("parts", parts).drop("size"), "crowd")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return dealt.select("crowd", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "n", "root", "part", "values")


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The size of the intersection of the sets of each pair."""
    if len(a) <= 2 * len(sets) or len(a) < 16:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.flatnonzero(count[value] > 1)  # the others are in no intersection
    owner, value = owner[often], np.unique(value[often], return_inverse=True)[1]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    product = np.zeros((len(sets), len(sets)), np.float32)
    step = max(1, _CELLS // len(sets))
    for start in range(0, int(value[-1]) + 1 if len(value) else 0, step):
        low, high = np.searchsorted(value, [start, start + step])
        matrix = np.zeros((len(sets), step), np.float32)
        matrix[owner[low:high], value[low:high] - start] = 1
        product += matrix @ matrix.T
    return product[a, b].astype(np.int64)


class _Joined:
    """Union-find over the places of a block."""

    def __init__(self, roots: np.ndarray):
        self.up = {int(r): int(r) for r in roots}

    def find(self, r: int) -> int:
        while self.up[r] != r:
            self.up[r] = r = self.up[self.up[r]]
        return r

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _meeting(n: np.ndarray, root: np.ndarray, part: np.ndarray, values: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block that share a listed value, have sizes near each other and are of two roots and, where the
    block is of two parts, of two parts."""
    distinct, at = np.unique(values, return_inverse=True)
    owner = np.repeat(np.arange(len(n)), counts)
    product = np.zeros((len(n), len(n)), np.float32)
    step = max(1, _CELLS // len(n))
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for start in range(0, len(distinct), step):
        low, high = np.searchsorted(at, [start, start + step])
        share = np.zeros((len(n), min(step, len(distinct) - start)), np.float32)
        share[owner[low:high], at[low:high] - start] = 1
        product += share @ share.T
    may = np.triu(product > 0, 1) & (root[:, None] != root[None, :])
    may &= (n[:, None] * 100 >= n[None, :] * percent) & (n[None, :] * 100 >= n[:, None] * percent)
    if part.min() != part.max():
        may &= part[:, None] != part[None, :]
    return np.nonzero(may)


def block_links(node: np.ndarray, n: np.ndarray, root: np.ndarray, part: np.ndarray, values: list[np.ndarray], wide: list[np.ndarray], percent: int) -> tuple[list, list]:
    """Of one block: links that join components, as few as do so, and pairs that the full sets must decide.

    The pairs are those of :func:`_meeting`.
    """
    a, b = _meeting(n, root, part, np.concatenate(values), np.array([len(v) for v in values]), percent)
    if not len(a):
        return [], []
    joined, links, open_ = _Joined(root), [], []
    whole = (n[a] <= WIDE) & (n[b] <= WIDE)
    x, y = a[whole], b[whole]
    both = _shared(wide, x, y)
    reach = 100 * both >= percent * (n[x] + n[y] - both)
    for i, j in zip(x[reach], y[reach]):
        if joined.join(int(root[i]), int(root[j])):
            links.append((node[i], node[j]))
    x, y = a[~whole], b[~whole]
    for start in range(0, len(x), PAIRS):
        i, j = x[start : start + PAIRS], y[start : start + PAIRS]
        like = estimate(_padded([wide[v] for v in i], WIDE), _padded([wide[v] for v in j], WIDE), n[i], n[j], WIDE)
        for v, w in zip(i[like >= need(WIDE, percent) / WIDE], j[like >= need(WIDE, percent) / WIDE]):
            if joined.find(int(root[v])) != joined.find(int(root[w])):
                open_.append((node[v], node[w]))
    return links, open_


_BLOCK = ["crowd", "i", "j"]


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of sorted batches in tables of whole blocks, and where each block of a table begins, and its end."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in _BLOCK])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        held = rows.slice(cuts[-1]) if len(cuts) else rows
        if len(cuts):
            yield rows.slice(0, cuts[-1]), np.append(0, cuts)
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _numbers(rows: pa.Table) -> list[np.ndarray]:
    return [rows.column(c).to_numpy() for c in ("node", "n", "root", "part")]


def _lists(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All listed values, and how many each row has."""
    lists = rows.column("values").combine_chunks()
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)


def _candidates(crowds: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (crowd, i, j, node) of members with a partner in the block that may reach the limit."""

    def few(rows: pa.Table, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of all small blocks at once: neighbours, next but one and so on in runs of a value."""
        _, n, root, part = _numbers(rows)
        values, counts = _lists(rows)
        cross = rows.column("i").to_numpy() != rows.column("j").to_numpy()
        small = np.repeat(np.where(np.diff(cuts) <= _SMALL, np.arange(len(cuts) - 1), -1), np.diff(cuts))
        owner, block = np.repeat(np.arange(rows.num_rows), counts), np.repeat(small, counts)
        order = np.lexsort([owner, values, block])
        order = order[block[order] >= 0]
        owner, values, block = owner[order], values[order], block[order]
        runs = np.cumsum(np.append(True, (values[1:] != values[:-1]) | (block[1:] != block[:-1]))) if len(owner) else owner
        found = [np.empty(0, np.int64)]
        for distance in range(1, _SMALL):
            at = np.flatnonzero(runs[distance:] == runs[:-distance])
            if not len(at):
                break
            a, b = owner[at], owner[at + distance]
            may = (root[a] != root[b]) & (n[a] * 100 >= n[b] * percent) & (n[b] * 100 >= n[a] * percent) & ~(cross[a] & (part[a] == part[b]))
            found.append(np.unique(a[may] * np.int64(rows.num_rows) + b[may]))
        code = np.unique(np.concatenate(found))
        return code // rows.num_rows, code % rows.num_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _whole_blocks(batches):
            _, n, root, part = _numbers(rows)
            own = _prints(rows.column("prints"), k)
            named = np.zeros(rows.num_rows, bool)

            def meet(a: np.ndarray, b: np.ndarray) -> None:
                for start in range(0, len(a), PAIRS):
                    x, y = a[start : start + PAIRS], b[start : start + PAIRS]
                    open_ = ~(named[x] & named[y])
                    x, y = x[open_], y[open_]
                    _, reach = alike(own[x], own[y], n[x], n[y], k, percent)
                    named[x[reach]] = named[y[reach]] = True

            meet(*few(rows, cuts))
            for start, end in zip(cuts[:-1], cuts[1:]):
                if end - start > _SMALL:
                    a, b = _meeting(n[start:end], root[start:end], part[start:end], *_lists(rows.slice(start, end - start)), percent)
                    meet(a + start, b + start)
            chosen = pa.array(np.flatnonzero(named))
            yield pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().take(chosen) for c in [*_BLOCK, "node"]], names=[*_BLOCK, "node"])

    dealt = crowds.join(classes.select("node", "prints"), "node").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
    return dealt.select(*_BLOCK, "node", "n", "root", "part", "values", "prints").mapInArrow(lean(run), "crowd long, i int, j int, node long")


def _crowd_links(crowds: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from the blocks: ``sure`` links, and those to verify."""

    def emit(rows: pa.Table) -> pa.RecordBatch:
        values, counts = _lists(rows)
        links, open_ = block_links(*_numbers(rows), np.split(values, np.cumsum(counts)[:-1]), _values(rows.column("wide")), percent)
        pairs = [*links, *open_]
        sure = [True] * len(links) + [False] * len(open_)
        return pa.record_batch({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64()), "sure": pa.array(sure, pa.bool_())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _whole_blocks(batches):
            for start, end in zip(cuts[:-1], cuts[1:]):
                yield emit(rows.slice(start, end - start))

    dealt = crowds.join(wide.withColumnRenamed("what", "wide"), "node").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
    return dealt.select(*_BLOCK, "node", "n", "root", "part", "values", "wide").mapInArrow(lean(run), "a long, b long, sure boolean")


def link(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links) and kept (key = component_id).

    A null text, or one without words, has no shingles and is linked with nothing; with fewer words than
    ``width`` the whole sequence is the one shingle. Rows of one key are judged each by its text. A null key is
    never a component's smallest unless there is no other. Very long texts are taken whole, one at a time. An empty
    table gives no rows; other columns are not used.
    """
    rows = settle(sketches(docs, width, k, key, text), "near-sketches")
    grouped = rows.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("key").alias("first"), F.first("sketch").alias("sketch"), F.first("prints").alias("prints"))
    classes = settle(grouped.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    postings = settle(_postings(classes, k, percent), "near-postings")
    lists = postings.groupBy("value").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("node", "value").alias("draw"), "node", "n")).alias("head")).filter("members > 1")
    lists = lists.select("value", F.col("head.node").alias("a"), F.col("head.n").alias("na"))
    shared = settle(postings.join(lists, "value").withColumnsRenamed({"node": "b", "n": "nb"}), "near-lists")
    heads = shared.filter((F.col("a") != F.col("b")) & _near(percent)).select("a", "b").distinct()
    best = settle(_best(heads, classes, k, percent), "near-pairs")
    links = settle(_verified(best, classes, docs, width, percent, text), "near-links")
    roots = components(links, "near-components")
    own = roots.select(F.col("node").alias("b"), "root")
    members = shared.join(own, "b", "left").select("value", F.col("b").alias("node"), F.col("nb").alias("n"), F.coalesce("root", "b").alias("root"))
    crowds = settle(_crowds(settle(members, "near-members"), block), "near-crowds")
    chosen = settle(_candidates(crowds, classes, k, percent), "near-candidates")
    if not chosen.isEmpty():
        crowds = crowds.join(chosen, [*_BLOCK, "node"])
        wide = _pick(chosen.select("node").distinct(), classes, docs, width, text, WIDE)
        found = settle(_crowd_links(crowds, wide, percent), "near-crowd-links")
        stars = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = components(stars.unionByName(found.filter("sure").select("a", "b")), "near-components")
        left = settle(_across(found.filter("NOT sure").select("a", "b").distinct(), roots), "near-pairs")
        if not left.isEmpty():
            more = settle(_verified(left, classes, docs, width, percent, text), "near-links")
            stars = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
            roots = components(stars.unionByName(more), "near-components")
    named = classes.join(roots, "node", "left").select("s1", "s2", "n", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = settle(named.join(smallest, "root").select("s1", "s2", "n", "component"), "near-named")
    placed = rows.select("key", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key"))
    return placed.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
