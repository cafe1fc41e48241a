"""Benchmark decontamination: a BM25 index of test items, searched by block-max WAND with every training passage.

The items are the indexed documents and each passage of the corpus is a query. Weights are divided by the
score of the item's own text, so a score is the share of the item that the passage holds, and one limit serves
all items. Items stand in blocks; for each term the index keeps its largest weight per block. A sum of such
maxima bounds the score of every item of a block: blocks below the limit are passed over, first for a whole
document (whose words include those of its passages), then for a passage. In the others WAND moves the terms'
cursors to the next item that can reach the limit. What it retrieves is verified: the five-word shingles of the
question and the words of the answer must stand in the passage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import ALNUM, U64, lean, mix, pieces, settle, text_bytes, words

K1, B = 1.2, 0.75
BLOCK = 4
SCORE, QUESTION, ANSWER = 0.6, 0.5, 0.5
WIDTH = 5
# Bytes of item texts in one index; more items make more indexes, each searched with the whole corpus.
INDEX_BYTES = 16 << 20
_SENTENCE = regex.compile(r"(?<=[.!?\n])\s*(?=\S)")
_WORDED = regex.compile(r"[\p{L}\p{N}]")


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letters and digits, lower-cased) of the texts, and the text each is of."""
    return words(*text_bytes(pc.utf8_lower(column)), ALNUM)


def shingles(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of runs of ``width`` words, of all words if there are fewer."""
    width = min(width, len(h))
    if not width:
        return np.empty(0, U64)
    total = np.zeros(len(h) - width + 1, U64)
    for i in range(width):
        total = mix(total * U64(31) + h[i : len(h) - width + 1 + i])
    return np.unique(total)


def parts(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence answers those before it; a single one is both.

    A piece without a letter or digit, as a closing mark or dots, belongs to the piece before it, or the one after.
    """
    cuts: list[str] = []
    for piece in filter(None, _SENTENCE.split(text.strip())):
        if cuts and not (_WORDED.search(piece) and _WORDED.search(cuts[-1])):
            cuts[-1] += piece
        else:
            cuts.append(piece)
    return ("".join(cuts[:-1]), cuts[-1]) if len(cuts) > 1 else (text, text)


@dataclass
class Index:
    items: list  # item ids
    terms: np.ndarray  # sorted hashes
    heads: np.ndarray  # postings of term t: heads[t] to heads[t + 1]
    item: np.ndarray
    weight: np.ndarray
    top: np.ndarray  # largest weight of each term
    block_heads: np.ndarray
    block: np.ndarray
    block_top: np.ndarray
    questions: list[np.ndarray]
    widths: list[int]  # words to a shingle of the question: WIDTH, or all that it has
    answers: list[np.ndarray]
    posting_lists: tuple[list[int], list[float]]  # ``item`` and ``weight`` once more, for the cursors
    window: int  # words of a passage: any item lies whole in one, as the next begins half a passage on

    @classmethod
    def build(cls, items: list[tuple], frequency: dict[int, int] | None, count: int, mean: float) -> Index | None:
        """``items``: id and text. ``frequency``: items of each term over all indexes (None: this is the only one)."""
        column = pa.array([t for _, t in items], pa.string())
        h, owner = terms(column)
        if not len(h):
            return None
        length = np.bincount(owner, minlength=len(items))
        vocabulary, which = np.unique(h, return_inverse=True)
        pair, times = np.unique(which * len(items) + owner, return_counts=True)
        term, item = pair // len(items), pair % len(items)
        df = np.bincount(term) if frequency is None else np.array([frequency[int(v)] for v in vocabulary.view(np.int64)])
        weight = np.log1p((count - df + 0.5) / (df + 0.5))[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * length[item] / mean))
        weight = weight / np.bincount(item, weights=weight, minlength=len(items))[item]
        heads = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        blocks, at = np.unique(term * (len(items) // BLOCK + 1) + item // BLOCK, return_index=True)
        block_term, block = blocks // (len(items) // BLOCK + 1), blocks % (len(items) // BLOCK + 1)
        asked, answered = zip(*(parts(t or "") for _, t in items))
        split = [[terms(pa.array([t]))[0] for t in side] for side in (asked, answered)]
        return cls(
            [i for i, _ in items], vocabulary, heads, item, weight, np.maximum.reduceat(weight, heads[:-1]),
            np.searchsorted(block_term, np.arange(len(vocabulary) + 1)), block, np.maximum.reduceat(weight, at),
            [shingles(s) for s in split[0]], [min(WIDTH, max(1, len(s))) for s in split[0]], [np.unique(s) for s in split[1]], (item.tolist(), weight.tolist()), 2 * int(length.max()),
        )

    def bounds(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """For each query (given by distinct pairs of row and term) and block, what no item there can exceed."""
        sizes = self.block_heads[term + 1] - self.block_heads[term]
        ends = np.cumsum(sizes)
        at = np.repeat(self.block_heads[term] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        width = len(self.items) // BLOCK + 1
        return np.bincount(np.repeat(row, sizes) * width + self.block[at], weights=self.block_top[at], minlength=rows * width).reshape(rows, width)

    def search(self, query: np.ndarray, bound: np.ndarray, limit: float) -> list[tuple[int, float]]:
        """All items of score ``limit`` or more, by WAND over the blocks whose ``bound`` reaches it."""
        found = []
        items, weights = self.posting_lists
        live = [(int(self.heads[t]), int(self.heads[t + 1]), float(self.top[t])) for t in query]
        for block in np.flatnonzero(bound >= limit).tolist():
            first, last = block * BLOCK, (block + 1) * BLOCK
            cursors, later = [], []  # of the block: item, place, end in the block, largest weight
            for at, end, top in live:
                at = bisect_left(items, first, at, end)
                if at < end:
                    later.append((at, end, top))
                    stop = bisect_left(items, last, at, min(end, at + BLOCK))
                    if at < stop:
                        cursors.append((items[at], at, stop, top))
            live = later
            while cursors:
                cursors.sort()
                total = 0.0
                for pivot, (item, _, _, top) in enumerate(cursors):
                    total += top
                    if total >= limit:
                        break
                else:
                    break
                if cursors[0][0] == item:
                    score = sum(weights[at] for i, at, _, _ in cursors if i == item)
                    if score >= limit:
                        found.append((item, score))
                    moved = [(at + 1 if i == item else at, stop, top) for i, at, stop, top in cursors]
                else:  # those before the pivot go on to its item
                    moved = [(bisect_left(items, item, at, stop) if i < item else at, stop, top) for i, at, stop, top in cursors]
                cursors = [(items[at], at, stop, top) for at, stop, top in moved if at < stop]
        return found

    def leaks(self, h: np.ndarray, owner: np.ndarray, texts: int, limits: tuple[float, float, float]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, share of the question, share of the answer) of what passes; the best passage of each."""
        score_limit, question_limit, answer_limit = limits
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        hits = np.flatnonzero(self.terms[at] == h)
        at = at[hits]
        pairs = np.unique(owner[hits] * len(self.terms) + at)
        whole = self.bounds(pairs // len(self.terms), pairs % len(self.terms), texts)
        begins = np.searchsorted(owner, np.arange(texts + 1))
        step = self.window // 2
        for text in np.flatnonzero((whole >= score_limit - 1e-9).any(axis=1)):
            low, high = np.searchsorted(hits, begins[text]), np.searchsorted(hits, begins[text + 1])
            size = int(begins[text + 1] - begins[text])
            windows = max(1, -(-size // step) - 1)
            place = (hits[low:high] - begins[text]) // step
            inside = np.concatenate([place, place - 1])  # each word is in the passage of its half and in the one before
            term = np.concatenate([at[low:high]] * 2)
            fits = (inside >= 0) & (inside < windows)
            pairs = np.unique(inside[fits] * len(self.terms) + term[fits])
            row, term = pairs // len(self.terms), pairs % len(self.terms)
            bound = np.minimum(self.bounds(row, term, windows), whole[text])
            best: dict[int, tuple] = {}
            for passage in np.flatnonzero((bound >= score_limit - 1e-9).any(axis=1)):
                query = term[np.searchsorted(row, passage) : np.searchsorted(row, passage + 1)]
                retrieved = self.search(query, bound[passage], score_limit - 1e-9)
                if not retrieved:
                    continue
                start = int(begins[text]) + int(passage) * step
                piece = h[start : min(start + self.window, int(begins[text + 1]))]
                single, runs = np.unique(piece), {}
                for item, score in retrieved:
                    asked, answer, width = self.questions[item], self.answers[item], self.widths[item]
                    if width not in runs:
                        runs[width] = shingles(piece, width)
                    share = float(np.isin(asked, runs[width], assume_unique=True).mean()) if len(asked) else 0.0
                    heard = float(np.isin(answer, single, assume_unique=True).mean()) if len(answer) else 0.0
                    if share >= question_limit and heard >= answer_limit:
                        best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score, share, heard))
            for item, shares in best.items():
                yield int(text), item, *shares


def indexes(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """One index for each ``INDEX_BYTES`` of items; weights come from counts over all of them."""
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-size // INDEX_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, owner = terms(batch.column("text"))
            distinct = np.unique(np.stack([owner.astype(U64), h]), axis=1)[1] if len(h) else h
            yield pa.record_batch({"term": pa.array(distinct.view(np.int64)), "words": pa.array([len(h), *[0] * (len(distinct) - 1)] if len(distinct) else [], pa.int64())})

    counted = settle(rows.mapInArrow(lean(count), "term long, words long").groupBy("term").agg(F.count("*").alias("n"), F.sum("words").alias("words")), "item-terms") if groups else None
    number = rows.count()
    mean = (counted.agg(F.sum("words")).first()[0] or 0) / max(1, number) if groups else 0
    for group in range(groups):
        mine = rows.filter(F.pmod(F.xxhash64("key", "text"), F.lit(groups)) == group)
        chosen = [(r.key, r.text) for r in mine.collect()]
        frequency = None
        if groups > 1:
            h = np.unique(terms(pa.array([t for _, t in chosen], pa.string()))[0]).view(np.int64)
            known = rows.sparkSession.createDataFrame([(int(t),) for t in h], "term long")
            frequency = {r.term: r.n for r in counted.join(known, "term").collect()}
        if index := Index.build(chosen, frequency, number, mean):
            yield index


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", limits: tuple[float, float, float] = (SCORE, QUESTION, ANSWER)) -> DataFrame:
    """Leaks: a row per document and item (its key, item_id, score, question_overlap, answer_overlap).

    ``limits``: the score that retrieves, then the shares of the question and of the answer that verify. Null and
    empty texts and items match nothing; repeated rows match alike; other columns are not used. The driver reads
    the items, one index at a time; each index goes to the tasks, its size bounded by ``INDEX_BYTES``.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = f"key {dict(rows.dtypes)['key']}, item_id {dict(items.dtypes)['item_id']}, score double, question_overlap double, answer_overlap double"
    found = None
    for index in indexes(items):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text"):
                    column = pc.fill_null(part.column("text"), "")
                    hits = list(index.leaks(*terms(column), part.num_rows, limits))
                    if hits:
                        text_, item, *shares = zip(*hits)
                        yield pa.record_batch([part.column("key").take(pa.array(text_)), pa.array([index.items[i] for i in item]), *map(pa.array, shares)], names=["key", "item_id", "score", "question_overlap", "answer_overlap"])

        leaks = rows.mapInArrow(lean(run), schema)
        found = leaks if found is None else found.unionByName(leaks)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("key", key)
