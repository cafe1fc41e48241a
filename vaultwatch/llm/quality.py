"""Quality of documents by co-training: two classifiers over separate views teach each other.

One view is the text's content, as the set of its words. The other is the page's metadata: language, source,
length and the layout's statistics, each cut into bins. In every round both classifiers score all unlabelled
documents, in tasks, and each labels those that it is surest of for the other to learn from. Labelled documents held
back from the rounds calibrate both views and their combination, which scores all documents. They also judge the
exchange: labels by which a view's loss on them rises are taken back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import ALNUM, U64, lean, pieces, settle, text_bytes, words

LABELLED = 8_000  # labelled documents to fit on; those beyond are unlabelled ones. All else covers every document
ROUNDS, SURE, CERTAIN = 3, 500, 0.97  # rounds of exchange, pseudo-labels that each view gives in one, and their probability
WORD_BITS, CHOSEN_WORDS, STEM = 18, 4096, 6  # a stem is a word's first bytes
BINS = 12
NAME_BITS = 8
THRESHOLD = 0.5
_SIGN, _DIGIT, _UPPER, _LINE = (np.zeros(256, bool) for _ in range(4))
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-"]] = True
_DIGIT[[*range(48, 58)]] = True
_UPPER[[*range(65, 91)]] = True
_LINE[10] = True
STATISTICS = ("n_chars", "words", "bytes_per_word", "signs", "digits", "capitals", "words_per_line", "distinct", "repeats")


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of columns text, lang, source and n_chars: the word cells (owner, cell; distinct), the statistics (a row per
    text) and the cells of language and source (two per text)."""
    raw, at = text_bytes(batch.column("text"))
    n, size = batch.num_rows, np.diff(at)
    h, owner = words(raw, at, ALNUM)
    stem, _ = words(raw, at, ALNUM, STEM)
    cells = np.unique(np.concatenate([owner, owner]) << WORD_BITS | (np.concatenate([h, ~stem]) >> U64(64 - WORD_BITS)).astype(np.int64))
    count = np.bincount(owner, minlength=n)
    distinct = np.bincount(np.unique(owner << WORD_BITS | (h >> U64(64 - WORD_BITS)).astype(np.int64)) >> WORD_BITS, minlength=n)
    repeats = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=n) if len(h) else count
    sums = [np.diff(np.concatenate([[0], np.cumsum(kind[raw])])[at]) for kind in (_SIGN, _DIGIT, _UPPER, _LINE)]
    chars = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)
    some, held = np.maximum(size, 1), np.maximum(count, 1)
    rows = [np.where(np.isfinite(chars), chars, size), count, size / held, *(s / some for s in sums[:3]), count / (sums[3] + 1), distinct / held, repeats / held]
    names = []
    for i, column in enumerate(("lang", "source")):
        told = words(*text_bytes(batch.column(column).cast(pa.string())), np.ones(256, bool))
        cell = np.zeros(n, np.int64)
        cell[told[1]] = (told[0] >> U64(64 - NAME_BITS)).astype(np.int64)
        names.append(i << NAME_BITS | cell)
    return cells >> WORD_BITS, cells & ((1 << WORD_BITS) - 1), np.stack(rows, axis=1), np.stack(names, axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def regression(owner: np.ndarray, cell: np.ndarray, label: np.ndarray, cells: int, weight: np.ndarray, penalty: float, steps: int = 150) -> np.ndarray:
    """Logistic regression on sets of cells; the last weight is the constant. Adam on all rows at a time."""
    w, m, v = np.zeros(cells + 1), np.zeros(cells + 1), np.zeros(cells + 1)
    total = weight.sum()
    for t in range(1, steps + 1):
        miss = (_logistic(np.bincount(owner, weights=w[cell], minlength=len(label)) + w[-1]) - label) * weight / total
        slope = np.append(np.bincount(cell, weights=miss[owner], minlength=cells) + penalty * w[:-1], miss.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _dense(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression on few numbers, by Newton's steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _logistic(x @ w)
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (p - label) + 1e-3 * w)
    return w


@dataclass
class Model:
    content: np.ndarray  # weight of each word cell, and the constant
    edges: np.ndarray  # bins of each statistic
    metadata: np.ndarray
    scales: np.ndarray  # logit of each view: slope and constant
    blend: np.ndarray  # of both logits and the lower one

    def cells(self, statistics: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The metadata cells of each row."""
        bins = [i * (BINS + 1) + np.searchsorted(e, s, side="right") for i, (e, s) in enumerate(zip(self.edges, statistics.T))]
        return np.column_stack([*bins, len(self.edges) * (BINS + 1) + names])

    def score(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by content, by metadata and by both."""
        x, both = self.calibrated(*self.raw(Rows(*views(batch))))
        return _logistic(x[:, 0]), _logistic(x[:, 1]), _logistic(both)

    def raw(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        a = np.bincount(rows.owner, weights=self.content[rows.cell], minlength=len(rows)) + self.content[-1]
        return a, self.metadata[self.cells(rows.statistics, rows.names)].sum(axis=1) + self.metadata[-1]

    def scores(self, rows: Rows) -> np.ndarray:
        """The calibrated logit of each view, a column each."""
        return self.calibrated(*self.raw(rows))[0]

    def calibrated(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.stack([a, b], axis=1) * self.scales[:, 0] + self.scales[:, 1]
        return x, np.column_stack([x, x.min(axis=1)]) @ self.blend[:-1] + self.blend[-1]


def _choose(parts: Iterable[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> np.ndarray:
    """Of owners and cells, in parts, the word cells that tell the classes apart best by chi-square, at 0.1 % significance."""
    seen, good = np.zeros(1 << WORD_BITS), np.zeros(1 << WORD_BITS)
    for owner, cell in parts:
        seen += np.bincount(cell, minlength=1 << WORD_BITS)
        good += np.bincount(cell, weights=label[owner], minlength=1 << WORD_BITS)
    share, n = label.mean(), len(label)
    gain = np.where(seen >= 5, (good - seen * share) ** 2 / np.maximum(seen * share * (1 - share) * (1 - seen / (n + 1)), 1e-9), 0)
    best = np.argsort(-gain, kind="stable")[:CHOSEN_WORDS]
    keep = np.zeros(1 << WORD_BITS, bool)
    keep[best[gain[best] > 10.83]] = True
    return keep


STRETCH = 1 << 17  # entries that the fit widens to eight bytes at a time


@dataclass
class Rows:
    """Documents as the views see them; ``owner`` and ``cell`` are sorted by owner, four bytes each where many are kept."""

    owner: np.ndarray
    cell: np.ndarray
    statistics: np.ndarray
    names: np.ndarray

    def __len__(self) -> int:
        return len(self.names)

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> Rows:
        """From columns cells, statistics and names."""
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in map(batch.column, ("cells", "statistics", "names"))]
        cells, statistics, names = columns
        owner = np.repeat(np.arange(len(cells), dtype=np.int32), pc.list_value_length(cells).to_numpy())
        numbers = statistics.flatten().to_numpy().reshape(-1, len(STATISTICS))
        return cls(owner, cells.flatten().to_numpy(), numbers, names.flatten().to_numpy().astype(np.int64).reshape(-1, 2))

    def stretches(self) -> Iterator[Rows]:
        """The rows in runs of about ``STRETCH`` entries, at least one row each; owners count from the run's first row."""
        ends = np.searchsorted(self.owner, np.arange(len(self) + 1, dtype=np.int32))
        start = 0
        while start < len(self):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STRETCH, side="right")) - 1)
            part = slice(ends[start], ends[stop])
            yield Rows(self.owner[part] - np.int32(start), self.cell[part], self.statistics[start:stop], self.names[start:stop])
            start = stop

    def add(self, more: Rows) -> Rows:
        return Rows(np.concatenate([self.owner, more.owner + np.int32(len(self))]), np.concatenate([self.cell, more.cell]), np.concatenate([self.statistics, more.statistics]), np.concatenate([self.names, more.names]))


# Of a model and the keys that each view has labelled: per view the keys, labels and rows that it labels next.
Exchange = Callable[[Model, list[set], float], list[tuple[list, np.ndarray, Rows]]]


def fit(rows: Rows, good: np.ndarray, exchange: Exchange) -> Model | None:
    """From labelled documents and whether each is good (1 or 0). None without both classes."""
    held = np.arange(len(good)) % 5 == 0
    if len(set(good[~held])) < 2 or len(set(good[held])) < 2:
        return None
    model = Model(np.zeros(0), np.quantile(rows.statistics, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T, np.zeros(0), np.tile([1.0, 0.0], (2, 1)), np.zeros(4))
    cells = len(STATISTICS) * (BINS + 1) + (2 << NAME_BITS)
    taught = [np.where(held, np.nan, good) for _ in range(2)]  # what each view learns from
    truth, n, given = good[held], len(good), [set(), set()]

    def learn(view: int) -> tuple[np.ndarray, np.ndarray]:
        use = np.isfinite(taught[view])
        number = np.cumsum(use) - 1
        label = taught[view][use]
        weight = np.where(np.flatnonzero(use) < n, 1.0, 0.5)
        if view == 0:

            def entries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                first = 0
                for part in rows.stretches():
                    owner = part.owner + first
                    mine = use[owner]
                    yield number[owner[mine]], part.cell[mine]
                    first += len(part)

            chosen = np.flatnonzero(_choose(entries(), label))
            place = np.full(1 << WORD_BITS, -1)
            place[chosen] = np.arange(len(chosen))
            kept = [(o[keep], place[c[keep]]) for o, c in entries() for keep in [place[c] >= 0]]
            o, c = (np.concatenate([k[i] for k in kept]) for i in range(2))
            del kept
            told = regression(o, c, label, len(chosen), weight, 1e-4)
            w = np.zeros((1 << WORD_BITS) + 1)
            w[chosen], w[-1] = told[:-1], told[-1]
            score = np.concatenate([np.bincount(part.owner, weights=w[part.cell], minlength=len(part)) for part in rows.stretches()])
            return w, (score + w[-1])[:n][held]
        meta = model.cells(rows.statistics, rows.names)
        o, c = number[np.repeat(np.flatnonzero(use), meta.shape[1])], meta[use].ravel()
        w = regression(o, c, label, cells, weight, 1e-4)
        return w, (w[meta].sum(axis=1) + w[-1])[:n][held]

    def calibrate(score: np.ndarray) -> tuple[np.ndarray, float]:
        """Slope and constant of the logit, and the loss by them."""
        scale = _dense(score[:, None], truth)
        p = np.clip(_logistic(score * scale[0] + scale[1]), 1e-6, 1 - 1e-6)
        return scale, -float(np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p)))

    found = []
    for view in range(2):
        weights, score = learn(view)
        found.append((weights, score, *calibrate(score)))
    for turn in range(ROUNDS + 1):
        (model.content, a, x, _), (model.metadata, b, y, _) = found
        model.scales = np.array([x, y])  # a view that cannot know is never sure
        if turn == ROUNDS:
            break
        for view, (keys, label, more) in enumerate(exchange(model, given, float(good.mean()))):
            given[view].update(keys)
            rows = rows.add(more)
            former = [np.append(t, np.full(len(label), np.nan)) for t in taught]
            other = 1 - view
            taught = [np.append(t, label) if i == other else former[i] for i, t in enumerate(taught)]
            weights, score = learn(other)
            told = (weights, score, *calibrate(score))
            if told[-1] <= found[other][-1]:
                found[other] = told
            else:  # labels that make a view worse on the documents held back are taken back
                taught = former
    x, _ = model.calibrated(a, b)
    model.blend = _dense(np.column_stack([x, x.min(axis=1)]), truth)
    return model


def _features(docs: DataFrame) -> DataFrame:
    """doc_id, ``key`` (the same for rows that the views see alike), and the views as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                owner, cell, statistics, names = views(part)
                ends = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)), pa.int32())
                at = [pa.array(np.arange(part.num_rows + 1) * width, pa.int32()) for width in (len(STATISTICS), 2)]
                lists = [pa.ListArray.from_arrays(e, pa.array(v)) for e, v in zip((ends, *at), (cell.astype(np.int32), statistics.ravel(), names.ravel().astype(np.int32)))]
                yield pa.record_batch([part.column("doc_id"), part.column("key"), *lists], names=["doc_id", "key", "cells", "statistics", "names"])

    seen = ("text", "lang", "source", "n_chars")
    key = F.xxhash64(*seen, *(F.col(c).isNull() for c in seen))
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", key.alias("key"), *seen).mapInArrow(lean(run), f"doc_id {kind}, key long, cells array<int>, statistics array<double>, names array<int>")


def surest(features: DataFrame, model: Model, given: list[set], share: float, count: int = SURE) -> list[tuple[list, np.ndarray, Rows]]:
    """Per view the ``count`` documents of the features that it is surest of and has not labelled: their keys, labels
    and rows. ``share`` of them are good; equal documents count as one, and equal scores go by key.

    All documents are scored. A task sends as many rows of each view and label as there are to be chosen at most.
    """
    sides = [(view, good, n) for view in range(2) for good, n in ((1, round(count * share)), (0, count - round(count * share)))]
    bound = float(np.log(CERTAIN / (1 - CERTAIN)))
    past = [np.array(sorted(keys), np.int64) for keys in given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(sides)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            scores = model.scores(Rows.of(batch)).T
            for i, (view, good, n) in enumerate(sides):
                sure = np.clip(scores[view] if good else -scores[view], -30, 30)
                fresh = (sure >= bound) & ~np.isin(key, past[view])
                keys, first = np.unique(np.concatenate([best[i][0], key[fresh]]), return_index=True)
                sure = np.concatenate([best[i][1], sure[fresh]])[first]
                order = np.lexsort((keys, -sure))[:n]
                best[i] = keys[order], sure[order]
        for (view, good, _), (keys, sure) in zip(sides, best):
            yield pa.record_batch({"view": pa.array([view] * len(keys), pa.int32()), "good": pa.array([good] * len(keys), pa.int32()), "key": pa.array(keys), "sure": pa.array(sure)})

    found = features.select("key", "cells", "statistics", "names").mapInArrow(lean(run), "view int, good int, key long, sure double")
    found = settle(found.groupBy("view", "good", "key").agg(F.max("sure").alias("sure")), "quality-sure")
    chosen = {(view, good): [r.key for r in found.filter((F.col("view") == view) & (F.col("good") == good)).orderBy(F.desc("sure"), "key").limit(n).collect()] for view, good, n in sides}
    keys = sorted(set().union(*chosen.values()))
    wanted = features.sparkSession.createDataFrame([(k,) for k in keys], "key long")
    told = features.join(F.broadcast(wanted), "key").dropDuplicates(["key"]).select("key", "cells", "statistics", "names").toArrow().combine_chunks()
    place = {k: i for i, k in enumerate(told.column("key").to_pylist())}
    out = []
    for view in range(2):
        good, bad = chosen[view, 1], chosen[view, 0]
        rows = Rows.of(told.take(pa.array([place[k] for k in good + bad], pa.int64())))
        out.append((good + bad, np.repeat([1.0, 0.0], [len(good), len(bad)]), rows))
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on about ``LABELLED`` of the labels, chosen by a hash of doc_id, and what the views tell each other of all
    other documents, labelled ones outside the sample included.

    Good is a quality of 1 and not toxic (null: not). Labels without a quality are no labels; the lowest of several
    for one document holds. Of a labelled doc_id that stands in several rows, that of the lowest key is learned from;
    the others, and rows without a doc_id, are unlabelled ones. Rows that the views see alike count as one. Texts are
    seen whole, very long ones as runs of their own. Without documents of both classes there is no model.
    """
    good = ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int")
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good).alias("good"))
    known = settle(known, "labels")
    count = known.count()
    if not count:
        return None
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    sample = settle(known.filter(place < min(1.0, LABELLED / count)), "learning-sample")
    features = settle(_features(docs), "quality-features")
    chosen = settle(features.select("doc_id", "key").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "good").agg(F.min("key").alias("key")), "learning-rows")
    # The driver gets numbers, no texts: some kilobytes for each document of the sample.
    told = features.join(F.broadcast(chosen), ["doc_id", "key"]).dropDuplicates(["doc_id"]).toArrow().combine_chunks()
    if not told.num_rows:
        return None
    told = told.take(pc.sort_indices(told, sort_keys=[("doc_id", "ascending")])).combine_chunks()
    told = told.take(pa.array(np.random.default_rng(1).permutation(told.num_rows))).combine_chunks()
    rows, label = Rows.of(told), told["good"].to_numpy().astype(float)
    del told
    pa.default_memory_pool().release_unused()
    others = features.join(F.broadcast(chosen.select("key").distinct()), "key", "left_anti")
    return fit(rows, label, lambda model, given, share: surest(others, model, given, share))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns, and content, metadata, score (probabilities of a good document) and kept.

    Null texts, languages, sources and lengths are values of their own; without a model all scores are 1. Repeated
    rows are judged alike. Columns of these names are replaced.
    """
    added = ("content", "metadata", "score", "kept")
    names = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text"):
                found = model.score(rows) if model else [np.ones(rows.num_rows)] * 3
                yield pa.record_batch([*(rows.column(c) for c in names), *map(pa.array, found), pa.array(found[2] >= THRESHOLD)], names=[*names, *added])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*names).dtypes)
    return docs.select(*names).mapInArrow(lean(run), f"{schema}, content double, metadata double, score double, kept boolean")


def accept(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows that the model takes for good, with all their columns, whatever their names; without a model all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text"):
                yield rows.filter(pa.array(model.score(rows)[2] >= THRESHOLD))

    return docs.mapInArrow(lean(run), docs.schema) if model else docs
