"""Byte-level BPE on padded matrices: every row merges its leftmost pair of the lowest rank, round by round.

The ranks of a tiktoken vocabulary and its split pattern give the same ids as that library does without
special tokens. Each distinct piece of a task is encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vaultwatch.llm.common import lean, pieces

NONE = np.int32(2**31 - 1)
# Rows up to this length merge one pair a round; in longer ones a round takes all places of the lowest rank, so that
# time does not grow with the square of the length.
MATRIX_WIDTH = 64
ROWS = 1 << 15
CELLS = 1 << 18  # of a matrix of longer rows; one row may have more
# Distinct pieces that a worker remembers; more are encoded again, with the same ids.
REMEMBERED = 400_000


class PairTable:
    """Ranks of pairs of ids by open addressing: a power of two of slots, at most half of them in use."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.array([(a << 32) | b for a, b in pairs], np.uint64)
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(2 * len(pairs) - 1).bit_length()) if pairs else 4
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        at = self._home(keys)
        left = np.arange(len(keys))
        while len(left):  # all still without a place take the free slots of this probe; one key to a slot
            free = left[self.keys[at[left]] == np.uint64(2**64 - 1)]
            slots, chosen = np.unique(at[free], return_index=True)
            self.keys[slots] = keys[free[chosen]]
            self.ranks[slots] = ranks[free[chosen]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where the pair does not merge. A negative id merges with nothing."""
        found = np.full(len(left), NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[open_].astype(np.uint64) << np.uint64(32)) | right[open_].astype(np.uint64)
        at = self._home(keys)
        while len(open_):
            held = self.keys[at]
            same = held == keys
            found[open_[same]] = self.ranks[at[same]]
            go_on = ~same & (held != np.uint64(2**64 - 1))
            open_, keys, at = open_[go_on], keys[go_on], (at[go_on] + 1) & self.mask
        return found


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.table = PairTable(pairs)
        top = max(ranks.values()) + 1
        tokens = [b""] * top
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_ends = np.cumsum([len(t) for t in tokens])
        self.token_sizes = np.array([len(t) for t in tokens])

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}, pattern)

    def _matrix(self, rows: list[bytes]) -> list[np.ndarray]:
        """Rows of similar length, padded with -1."""
        sizes = np.array([len(r) for r in rows])
        width = int(sizes.max())
        ids = np.full((len(rows), width + 1), -1, np.int32)
        ids[np.arange(width + 1)[None, :] < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        done: list[np.ndarray] = [None] * len(rows)
        live = np.arange(len(rows))
        ranks = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width)
        while len(live):
            at = ranks.argmin(axis=1)  # the leftmost of the lowest
            lowest = ranks[np.arange(len(live)), at]
            over = lowest == NONE
            for i in np.flatnonzero(over):
                done[live[i]] = ids[i, : sizes[i]]
            go_on = ~over
            live, ids, ranks, sizes, at, lowest = live[go_on], ids[go_on], ranks[go_on], sizes[go_on], at[go_on], lowest[go_on]
            if not len(live):
                break
            # The right one of each pair goes; what follows moves up, and columns in use by no row are cut off.
            n, rows_at = np.arange(len(live)), np.arange(ids.shape[1])[None, :]
            ids[n, at] = lowest
            stay = rows_at != (at + 1)[:, None]
            ids = ids[stay].reshape(len(live), -1)
            ranks = ranks[stay[:, : ranks.shape[1]] | (rows_at[:, : ranks.shape[1]] == ranks.shape[1])].reshape(len(live), -1) if ranks.shape[1] > 1 else ranks
            sizes = sizes - 1
            width = int(sizes.max())
            ids = np.concatenate([ids[:, :width], np.full((len(live), 1), -1, np.int32)], axis=1)
            ranks = ranks[:, :width] if ranks.shape[1] >= width else np.concatenate([ranks, np.full((len(live), width - ranks.shape[1]), NONE, np.int32)], axis=1)
            before = np.maximum(at - 1, 0)
            ranks[n, before] = self.table.find(ids[n, before], ids[n, before + 1])
            ranks[n, at] = self.table.find(ids[n, at], ids[n, at + 1])
        return done

    def _wide(self, rows: list[bytes]) -> list[np.ndarray]:
        """Long rows of similar length, padded with -1 on both sides. A round takes of every row all places of its
        lowest rank from the left, up to the first that brings about a lower one: so many merges one after the other.
        There are no more rounds than ranks and places of the latter kind, however long a row is."""
        sizes = np.array([len(r) for r in rows])
        columns = np.arange(int(sizes.max()) + 3)[None, :]
        ids = np.full((len(rows), columns.size), -1, np.int32)
        ids[(columns > 0) & (columns <= sizes[:, None])] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        ranks = np.full(ids.shape, NONE, np.int32)
        ranks[:, :-1] = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), -1)
        done: list[np.ndarray] = [None] * len(rows)
        live = np.arange(len(rows))
        while True:
            lowest = ranks.min(axis=1)
            over = lowest == NONE
            for i in np.flatnonzero(over):
                done[live[i]] = ids[i, 1 : sizes[i] + 1].copy()
            if over.all():
                return done
            if over.any():
                live, ids, ranks, sizes, lowest = live[~over], ids[~over], ranks[~over], sizes[~over], lowest[~over]
            flat = ids.reshape(-1)
            at = np.flatnonzero(ranks == lowest[:, None])
            # Of places side by side, which overlap, every other one merges; padding parts the rows.
            n = np.arange(len(at))
            at = at[(n - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, n, 0))) % 2 == 0]
            row = at // ids.shape[1]
            made = lowest[row]
            before = np.where(np.diff(at, prepend=-2) == 2, made, flat[at - 1])
            lower = np.minimum(self.table.find(before, made), self.table.find(made, flat[at + 2])) < made
            earlier = np.cumsum(lower) - lower
            take = earlier == earlier[np.searchsorted(row, row)]
            at, row, made = at[take], row[take], made[take]
            flat[at] = made
            changed = np.zeros(flat.size, bool)
            changed[at] = True
            flat[at + 1] = -1  # the right one of each pair goes; what follows moves up
            sizes = sizes - np.bincount(row, minlength=len(sizes))
            stay = ids >= 0
            owner, column = np.nonzero(stay)
            place = np.cumsum(stay, axis=1)[owner, column]
            shape = (len(live), int(sizes.max()) + 3)
            moved, new_ids, new_ranks = owner * shape[1] + place, np.full(shape, -1, np.int32), np.full(shape, NONE, np.int32)
            new_ids.reshape(-1)[moved], new_ranks.reshape(-1)[moved] = ids[stay], ranks[stay]
            ids, ranks, flat = new_ids, new_ranks, new_ids.reshape(-1)
            fresh = moved[changed.reshape(stay.shape)[stay]]
            fresh = np.union1d(fresh, fresh - 1)
            ranks.reshape(-1)[fresh] = self.table.find(flat[fresh], flat[fresh + 1])

    def encode_pieces(self, rows: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece. A piece that is a token is that token; others go by buckets of like length."""
        done: list[np.ndarray] = [None] * len(rows)
        buckets: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            rank = self.ranks.get(row)
            if rank is not None:
                done[i] = np.array([rank], np.int32)
            elif len(row) > MATRIX_WIDTH:
                buckets.setdefault(-len(row).bit_length(), []).append(i)
            elif row:
                buckets.setdefault(-(-len(row) // 4), []).append(i)
            else:
                done[i] = np.empty(0, np.int32)
        for bucket, members in buckets.items():
            merge, height = (self._matrix, ROWS) if bucket > 0 else (self._wide, max(1, CELLS >> -bucket))
            for start in range(0, len(members), height):
                chosen = members[start : start + height]
                for i, ids in zip(chosen, merge([rows[i] for i in chosen])):
                    done[i] = ids
        return done

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.token_ends[ids] - ends, sizes)
        return self.token_bytes[at].tobytes()


class Encoder:
    """Encodes whole texts and remembers the pieces it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text. The new pieces of all the texts go through the matrices together."""
        split = self.vocabulary.pattern.findall
        found = [split(text) if text else [] for text in texts]
        seen = set().union(*found)
        fresh = [p for p in seen if p not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = list(seen)
        for piece, ids in zip(fresh, self.vocabulary.encode_pieces([p.encode() for p in fresh])):
            self.known[piece] = ids.tobytes()
        for row in found:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, row)), np.int32)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process and state of the file."""
    key = (path, os.path.getmtime(path), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary.read(path, pattern))
    return _ENCODERS[key]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``ids`` (array of int) and ``decoded`` (binary: the ids turned back to bytes).

    Null and empty texts have no ids. Very long texts, and pieces of any length, are encoded whole; repeated rows give
    the same ids, an empty table no rows. Keys are carried along as they are, repeated and null ones too; other
    columns are left out. ``path`` is a tiktoken file that every executor has at that place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, pattern)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = list(tool.encode(part.column("text").to_pylist()))
                ends = np.cumsum([0, *(len(i) for i in ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.record_batch(
                    {
                        "key": part.column("key"),
                        "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        "decoded": pa.array([tool.vocabulary.decode(i) for i in ids], pa.binary()),
                    }
                )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(lean(run), f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`encode`, but only n_tokens and the SHA-256 of the ids as text and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, pattern)
        names = np.array([str(i) for i in range(len(tool.vocabulary.token_sizes))], object)
        for batch in batches:
            for part in pieces(batch, "text"):
                counts, of_ids, of_bytes = [], [], []
                for ids in tool.encode(part.column("text").to_pylist()):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(names[ids].tolist()).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(tool.vocabulary.decode(ids)).hexdigest())
                yield pa.record_batch({"key": part.column("key"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string())})

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(lean(run), f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
