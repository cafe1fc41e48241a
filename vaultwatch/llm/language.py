"""Language of texts by a string kernel: blended-spectrum presence, Nyström landmarks, kernel ridge regression.

A text is the set of its n-grams of one to four bytes, after lower-casing and with each run of other than letters
as one blank. The kernel of two texts is the number of n-grams they share over the geometric mean of what each
has. Landmarks are texts of the learning sample; the kernel values against them, whitened, are the features of a
one-versus-rest ridge regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import pieces, text_bytes

UNKNOWN = "und"
NGRAMS = 4
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
# Texts to learn from, about so many of each language, and those of them that are landmarks.
PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 32
RIDGE = 1e-2
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def presence(column: pa.Array) -> np.ndarray:
    """One row per text, true at the bucket of each n-gram that it has. N-grams never cross texts."""
    raw, at = text_bytes(pc.utf8_lower(column))
    rows = len(at) - 1
    found = np.zeros((rows, BUCKETS), bool)
    letter = _LETTER[raw]
    keep = letter.copy()
    if len(keep):
        keep[1:] |= letter[:-1]  # the first of a run of others stands for all of it
    starts = at[:-1][at[:-1] < len(raw)]
    keep[starts] = letter[starts]
    codes = np.where(letter, raw, np.uint8(32))[keep].astype(np.uint32)
    sizes = np.add.reduceat(np.append(keep, False).astype(np.int64), at[:-1]) * (np.diff(at) > 0) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(rows, dtype=np.int64) << BUCKET_BITS, sizes)
    gram = np.zeros(len(codes), np.uint32)
    flat = found.ravel()
    for n in range(1, NGRAMS + 1):
        if len(codes) < n:
            break
        gram = (gram[: len(codes) - n + 1] << np.uint32(8)) | codes[n - 1 :]
        bucket = (gram * _FACTORS[n - 1] + np.uint32(n)) >> np.uint32(32 - BUCKET_BITS)
        same = owner[: len(gram)] == owner[n - 1 :]
        flat[(owner[: len(gram)] + bucket)[same]] = True
    return found


def has_letter(column: pa.Array) -> np.ndarray:
    plain = pc.fill_null(pc.match_substring_regex(column, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(~plain):
        plain[i] = any(c.isalpha() for c in column[i].as_py() or "")
    return plain


@dataclass
class Model:
    names: list[str]
    landmarks: np.ndarray  # packed presence, a row per landmark
    roots: np.ndarray  # square roots of the landmarks' n-gram counts
    weights: np.ndarray  # (landmarks + 1) x languages, the last row for the constant

    def score(self, found: np.ndarray) -> np.ndarray:
        return np.column_stack([kernel(found, self.landmarks, self.roots), np.ones(len(found))]) @ self.weights


def kernel(found: np.ndarray, landmarks: np.ndarray, roots: np.ndarray) -> np.ndarray:
    against = np.unpackbits(landmarks, axis=1).astype(np.float32)
    sizes = np.maximum(found.sum(axis=1, keepdims=True), 1)
    return (found.astype(np.float32) @ against.T) / (np.sqrt(sizes) * roots)


def fit(rows: list[tuple[str, bytes]]) -> Model | None:
    """From a language and the packed presence of each sample text; None without any."""
    names = sorted({lang for lang, _ in rows})
    if not names:
        return None
    packed = np.stack([np.frombuffer(p, np.uint8) for _, p in rows])
    labels = np.array([names.index(lang) for lang, _ in rows])
    chosen = np.concatenate([np.flatnonzero(labels == k)[:LANDMARKS_PER_LANGUAGE] for k in range(len(names))])
    landmarks = packed[chosen]
    roots = np.sqrt(np.maximum(np.unpackbits(landmarks, axis=1).sum(axis=1), 1))
    found = np.unpackbits(packed, axis=1)
    values, vectors = np.linalg.eigh(kernel(found[chosen], landmarks, roots).astype(float))
    solid = values > 1e-6 * values[-1]
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    features = np.column_stack([kernel(found, landmarks, roots) @ whiten, np.ones(len(rows))])
    weight = 1.0 / np.bincount(labels)[labels]  # each language counts alike
    goal = np.where(labels[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = features.T @ (features * weight[:, None])
    ridge = RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram))
    ridge[-1, -1] = 0
    solution = np.linalg.solve(gram + ridge + 1e-12 * np.eye(len(gram)), features.T @ (goal * weight[:, None]))
    return Model(names, landmarks, roots, np.vstack([whiten @ solution[:-1], solution[-1:]]))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", order: str = "doc_id") -> Model | None:
    """Fit on a sample of rows with a language and a letter: about ``PER_LANGUAGE`` of each language by the hash
    of the ``order`` column, which has no other use. Only the sample's presence bits, 4 KB a text, reach the driver."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    shares = known.groupBy(F.col(lang).alias("lang")).agg(F.least(F.lit(1.0), PER_LANGUAGE / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64(F.col(order).cast("string")), F.lit(1 << 40)) / float(1 << 40)
    rows = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place.alias("place"))
    few = rows.join(F.broadcast(shares), "lang") if shares.count() <= 10_000 else rows.join(shares, "lang")
    few = few.filter(F.col("place") < F.col("share")).select("lang", "place", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(has_letter(batch.column("text")), pa.bool_()))
            for part in pieces(batch, "text"):
                bits = np.packbits(presence(part.column("text")), axis=1)
                yield pa.record_batch({"lang": part.column("lang"), "place": part.column("place"), "bits": pa.array([b.tobytes() for b in bits], pa.binary())})

    sample = few.mapInArrow(pack, "lang string, place double, bits binary").collect()
    return fit([(r.lang, bytes(r.bits)) for r in sorted(sample, key=lambda r: (r.place, r.lang, bytes(r.bits)))])


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with lang_pred and score (0 to 1: 1 at a clear win).

    A null text, one without a letter, or a model that has learned nothing gives ``und`` and 0. Repeated rows
    are judged alike; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                for rows in (part.slice(i, 256) for i in range(0, part.num_rows, 256)):
                    column = rows.column("_text")
                    lettered = has_letter(column) & (model is not None)
                    names, scores = np.full(rows.num_rows, UNKNOWN, object), np.zeros(rows.num_rows)
                    if lettered.any():
                        values = model.score(presence(column.filter(pa.array(lettered))))
                        best = values.argmax(axis=1)
                        names[lettered] = np.array(model.names, object)[best]
                        scores[lettered] = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
                    yield pa.record_batch([*(rows.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores)], names=[*keep, "lang_pred", "score"])

    rows = docs.select(*keep, docs[text].alias("_text"))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")
