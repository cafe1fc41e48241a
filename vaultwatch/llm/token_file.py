"""Token ids in binary files: one array of ids, document boundaries in Elias-Fano code.

A file holds, little-endian: the ids, of two bytes where all of the vocabulary fit and else of four; the low bits
of the boundaries, their high bits in unary, samples for select; and a trailer with the counts and sizes of these.
The boundary after document i has its low bits in a packed array and its high part as the place of the i-th
one bit less i, so n boundaries up to m take about n * (2 + log2(m / n)) bits, and any of them is found
through the sample before it without reading the rest. There is no table of 64-bit offsets.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultwatch.llm.common import LOWER, SPACES, hash_spans, pieces, settle, text_bytes
from vaultwatch.llm.shared_files import attempt_name, new_folder, open_folder

MAGIC = b"TOKEF001"
TRAILER = struct.Struct("<QQQQQQQ8s")
SAMPLE = 256  # every so many one bits, the byte where the count goes on
# Distinct chunks that a worker remembers; more are encoded again, with the same ids.
REMEMBERED = 1_500_000
PIECE = 2 << 20  # bytes of text encoded at once: each distinct chunk of them once


@dataclass
class EliasFano:
    """A rising sequence of integers."""

    count: int
    low_bits: int
    low: np.ndarray  # bytes of the packed low bits
    high: np.ndarray  # bytes of the unary high bits
    samples: np.ndarray  # pairs (byte of ``high``, one bits before it), one pair for each SAMPLE ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(bits)) & 1 if bits else np.empty((n, 0), np.int64)
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        packed = np.packbits(high, bitorder="little")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])
        at = ones[::SAMPLE] // 8
        return cls(n, bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), packed, np.stack([at, before[at]], axis=1).astype("<u4").ravel())

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1, decoded from the sample before the first one on."""
        if last <= first:
            return np.empty(0, np.int64)
        pairs = self.samples.reshape(-1, 2).astype(np.int64)
        byte, seen = pairs[first // SAMPLE]
        end = pairs[(last - 1) // SAMPLE + 1][0] + 1 if (last - 1) // SAMPLE + 1 < len(pairs) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[byte:end], bitorder="little")) + byte * 8
        high = ones[first - seen : last - seen] - np.arange(first, last)
        if not self.low_bits:
            return high
        start = first * self.low_bits
        run = np.unpackbits(self.low[start // 8 : -(-last * self.low_bits // 8)], bitorder="little")
        run = run[start % 8 : start % 8 + (last - first) * self.low_bits].reshape(-1, self.low_bits)
        return (high << self.low_bits) | (run.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


class Writer:
    """Takes ids as they come and ends the file with the boundaries."""

    def __init__(self, out, width: int):
        self.out, self.kind, self.sizes = out, np.dtype(f"<u{width}"), []

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.sizes.append(sizes)

    def close(self) -> tuple[int, int]:
        """The numbers of documents and ids."""
        sizes = np.concatenate(self.sizes) if self.sizes else np.empty(0, np.int64)
        ends = np.cumsum(sizes, dtype=np.int64)
        coded, total = EliasFano.build(ends), int(ends[-1]) if len(ends) else 0
        for block in (coded.low, coded.high, coded.samples):
            self.out.write(block.tobytes())
        self.out.write(TRAILER.pack(len(sizes), total, self.kind.itemsize, coded.low_bits, len(coded.low), len(coded.high), len(coded.samples), MAGIC))
        return len(sizes), total


class TokenFile:
    """Reads documents by their number; the ids stay on disk until asked for."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2) - TRAILER.size
        source.seek(end)
        self.documents, self.ids, self.width, bits, low, high, samples, magic = TRAILER.unpack(source.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(self.ids * self.width)
        blocks = [np.frombuffer(source.read(n), kind) for n, kind in ((low, np.uint8), (high, np.uint8), (samples * 4, "<u4"))]
        self.ends = EliasFano(self.documents, bits, *blocks)

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where documents ``first`` to ``last`` - 1 begin, and the end of the last."""
        head = self.ends.select(first - 1, first) if first else np.zeros(1, np.int64)
        return np.concatenate([head, self.ends.select(first, last)])

    def read(self, start: int, end: int) -> np.ndarray:
        self.source.seek(self.width * start)
        return np.frombuffer(self.source.read(self.width * (end - start)), f"<u{self.width}").astype("<u4")


# Kinds of bytes: white space; letters; digits, signs and controls; the apostrophe and all bytes beyond ASCII.
_KIND = np.full(256, 3, np.uint8)
_KIND[:128] = 2
_KIND[ord("'")] = 3
_KIND[list(SPACES)] = 0
_KIND[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = 1


def chunks(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the chunks that the tokenizer treats one by one.

    It drops white space and never joins a letter with a digit or sign beside it; an apostrophe or a
    character beyond ASCII may belong to either, so there a chunk goes on.
    """
    kind = _KIND[raw]
    solid = kind > 0
    begins, ends = solid.copy(), solid.copy()
    cut = (kind[1:] + kind[:-1] == 3) & (kind[1:] != 0) & (kind[:-1] != 0) | ~solid[1:] | ~solid[:-1]
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
    cut[inner - 1] = True
    begins[1:] &= cut
    ends[:-1] &= cut
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all elements of the slices, one slice after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _looks(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length, first and last eight bytes of each span: all there is to know of one of up to sixteen bytes."""
    sizes = ends - begins
    padded = np.concatenate([np.zeros(8, np.uint8), raw, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    first, last = (np.ascontiguousarray(eights[at]).view("<u8").ravel() for at in (begins + 8, ends))
    outside = (8 * (8 - np.minimum(sizes, 8))).astype(np.uint64)  # bits of other spans
    return np.stack([sizes.astype(np.uint64), (first << outside) >> outside, (last >> outside) << outside], axis=1)


class WordEncoder:
    """Encodes texts by the library, each distinct chunk once; those of former batches are remembered."""

    def __init__(self, path: str, end_id: int):
        self.tool = Tokenizer.from_file(path)
        self.end_id = end_id
        self.width = 2 if max(end_id, self.tool.get_vocab_size() - 1) < 1 << 16 else 4
        self.special = [t.content.encode() for t in self.tool.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.looks = np.empty((0, 3), np.uint64)
        self.long: dict[int, bytes] = {}
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def _learn(self, hashes: np.ndarray, looks: np.ndarray, texts: list[str]) -> None:
        if len(self.hashes) + len(hashes) > REMEMBERED:
            self.forget()
        coded = [e.ids for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(c) for c in coded], np.int64)
        starts = np.cumsum(sizes) - sizes + len(self.ids)
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), "<u4", int(sizes.sum()))])
        known = np.concatenate([self.hashes, hashes])
        order = np.argsort(known)
        self.hashes = known[order]
        self.looks = np.concatenate([self.looks, looks])[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts])[order], np.concatenate([self.sizes, sizes])[order]

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of whole texts, where chunks would not do."""
        coded = [e.ids + [self.end_id] for e in self.tool.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), "<u4"), np.array([len(c) for c in coded], np.int64)

    def _same(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray, looks: np.ndarray, places: np.ndarray) -> bool:
        """Whether each chunk has the bytes of the remembered one of its hash."""
        if not np.array_equal(looks, self.looks[places]):
            return False
        for i in np.flatnonzero(ends - begins > 16):
            chunk = raw[begins[i] : ends[i]].tobytes()
            if self.long.setdefault(int(hashes[i]), chunk) != chunk:
                return False
        return True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end id after each text, and the number of each text's ids."""
        raw, at = text_bytes(texts)
        whole = raw.tobytes()
        if any(s in whole for s in self.special):  # a special token's name is one id and must stay whole
            return self._whole(texts)
        begins, ends = chunks(raw, at)
        docs = len(at) - 1
        if not len(begins):
            return np.full(docs, self.end_id, "<u4"), np.ones(docs, np.int64)
        small = LOWER[raw]
        hashes = hash_spans(small, begins, ends)
        beyond = np.concatenate([[0], np.cumsum(raw >= 128)])
        if beyond[-1]:  # beyond ASCII, case is left to the library
            foreign = np.flatnonzero(beyond[ends] > beyond[begins])
            hashes[foreign] = ~hash_spans(raw, begins[foreign], ends[foreign])
            small = small.copy()
            at_foreign = spread(begins[foreign], ends[foreign] - begins[foreign])
            small[at_foreign] = raw[at_foreign]
        looks = _looks(small, begins, ends)
        distinct, one, member = np.unique(hashes, return_index=True, return_inverse=True)
        fresh = np.flatnonzero(~self._place(distinct)[1])
        if len(fresh):
            if len(self.hashes) + len(fresh) > REMEMBERED:
                self.forget()
                fresh = np.arange(len(distinct))
            self._learn(distinct[fresh], looks[one[fresh]], [whole[begins[i] : ends[i]].decode() for i in one[fresh]])
        places = self._place(distinct)[0][member]
        if not self._same(small, begins, ends, hashes, looks, places):
            return self._whole(texts)
        owner = np.searchsorted(at, begins, side="right") - 1
        counts = np.bincount(owner, weights=self.sizes[places], minlength=docs).astype(np.int64)
        out = np.full(int(counts.sum()) + docs, self.end_id, "<u4")
        body = np.ones(len(out), bool)
        body[np.cumsum(counts + 1) - 1] = False
        out[body] = self.ids[spread(self.starts[places], self.sizes[places])]
        return out, counts + 1


_TOOLS: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _TOOLS:
        _TOOLS[path, end_id] = WordEncoder(path, end_id)
    return _TOOLS[path, end_id]


def write(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files in ascending order of the key, and return the settled list of files.

    Each task of a range of keys writes one file and a report (part, file, keys, documents, ids). Null texts are
    empty: the end id alone. Null keys come first; repeated keys stand side by side. ``path`` is a tokenizers
    file that every executor has there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[pa.Array] = []
        part = TaskContext.get().partitionId()
        files, home = open_folder(folder)
        name, tool = attempt_name(part, ".ids"), word_encoder(path, end_id)
        writer = None
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                writer = writer or Writer(files.open_output_stream(f"{home}/{name}", compression=None), tool.width)
                keys.append(piece.column("key"))
                writer.add(*tool.encode(piece.column("text")))
        if writer:
            documents, ids = writer.close()
            writer.out.close()
            row = {"part": [part], "file": [name], "keys": [pa.concat_arrays(keys).to_pylist()], "documents": [documents], "ids": [ids]}
            yield pa.record_batch([pa.array(v, t) for v, t in zip(row.values(), (pa.int64(), pa.string(), pa.list_(keys[0].type), pa.int64(), pa.int64()))], names=list(row))

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key")
    kind = dict(rows.dtypes)["key"]
    return settle(ordered.mapInArrow(run, f"part long, file string, keys array<{kind}>, documents long, ids long"), "token-files")


def read(listed: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before it), n_tokens and ids_crc32.

    Tasks read a file each and hold the ids of a few documents at a time.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = listed.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("origin"))
    kind = dict(listed.dtypes)["keys"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, home = open_folder(folder)
        for batch in batches:
            for row in range(batch.num_rows):
                origin, keys = batch.column("origin")[row].as_py(), batch.column("keys")[row].values
                with files.open_input_file(f"{home}/{batch.column('file')[row].as_py()}") as source:
                    tokens = TokenFile(source)
                    for first in range(0, tokens.documents, 1024):
                        last = min(tokens.documents, first + 1024)
                        at = tokens.bounds(first, last)
                        sums = [zlib.crc32(tokens.read(a, b).tobytes()) for a, b in zip(at, at[1:])]
                        yield pa.record_batch({"key": keys.slice(first, last - first), "start": pa.array(at[:-1] + origin), "n_tokens": pa.array(np.diff(at)), "ids_crc32": pa.array(sums, pa.int64())})

    found = listed.join(starts, "part").select("file", "keys", "origin")
    return found.mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def roundtrip(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    folder = new_folder(docs.sparkSession, "token-ids")
    return read(write(docs, folder, path, end_id, key, text), folder, key)
