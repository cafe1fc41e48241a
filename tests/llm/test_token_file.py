"""Token files against the tokenizers library and plain sums."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from vaultwatch.llm import token_file

PATH = P.path("word_bpe_49k.json")
TEXTS = [
    "It's Don'the ÉCOLE T̈a İB 12a3 '%%a' ab…cd",
    None,
    "",
    "   ",
    "a <|endoftext|> B<|startoftext|>",
    "x\x85y \x1cz \x1f q",
    "word " * 3000,
    "straße," * 9,
]


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("step", [0, 1, 5, 1000, 10**6])
def test_boundaries(n, step):
    values = np.cumsum(np.random.default_rng(n + step).integers(0, step + 1, n))
    coded = token_file.EliasFano.build(values)
    for first, last in ((0, n), (n // 2, n), (n - 1, n), (0, 1), (n // 3, n // 2)):
        assert coded.select(first, last).tolist() == values[first:last].tolist()
    bits = 8 * (coded.low.nbytes + coded.high.nbytes)
    assert bits <= n * (3 + np.log2(max(2, values[-1] / n))) + 16


@pytest.mark.parametrize("width", [2, 4])
def test_file_in_memory(width):
    rnd = random.Random(1)
    docs = [np.array([rnd.randrange(1 << 8 * width) for _ in range(rnd.randrange(1, 9))], "<u4") for _ in range(700)]
    out = io.BytesIO()
    writer = token_file.Writer(out, width)
    for start in range(0, 700, 100):
        some = docs[start : start + 100]
        writer.add(np.concatenate(some), np.array([len(d) for d in some]))
    assert writer.close() == (700, sum(map(len, docs)))
    tokens = token_file.TokenFile(out)
    at = tokens.bounds(300, 400)
    assert [tokens.read(a, b).tolist() for a, b in zip(at, at[1:])] == [d.tolist() for d in docs[300:400]]


def test_same_ids_as_the_library():
    tool = token_file.WordEncoder(PATH, 1)
    for rows in (TEXTS, [t for t in TEXTS if t is None or "<|" not in t], [None], TEXTS[:1] * 3):
        ids, counts = tool.encode(pa.array(rows, pa.string()))
        assert ids.tolist() == [i for t in rows for i in ids_of(t)]
        assert counts.tolist() == [len(ids_of(t)) for t in rows]


def test_tables(spark):
    rows = [(i * 3 % 101, TEXTS[i % len(TEXTS)], "x") for i in range(101)] + [(None, "null key", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(7)
    got = sorted(token_file.roundtrip(docs, PATH, 1).collect(), key=lambda r: r.start)
    want, start = [], 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = ids_of(text)
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    assert token_file.roundtrip(docs.limit(0), PATH, 1).collect() == []
    repeated = token_file.roundtrip(spark.createDataFrame([(1, "a b", "x")] * 3, "doc_id long, text string, ids string"), PATH, 1)
    assert sorted(r.start for r in repeated.collect()) == [0, 3, 6]


def test_chunks_that_share_a_hash_keep_their_own_ids(monkeypatch):
    """Words made to share a polynomial hash, and a hash that is the same for all."""
    from test_minhash_dedup import thue_morse

    rows = [f"see {w} here" for order in (8, 10, 11) for w in thue_morse(order)] + TEXTS[:1]
    tool = token_file.WordEncoder(PATH, 1)
    for row in rows:
        assert tool.encode(pa.array([row]))[0].tolist() == ids_of(row)
    assert token_file.WordEncoder(PATH, 1).encode(pa.array(rows))[0].tolist() == [i for t in rows for i in ids_of(t)]
    monkeypatch.setattr(token_file, "hash_spans", lambda raw, begins, ends: (ends - begins).astype(np.uint64))
    tool = token_file.WordEncoder(PATH, 1)
    for row in [*rows, "one two six ten one", "a" * 17 + " " + "a" * 16 + "b"]:
        assert tool.encode(pa.array([row]))[0].tolist() == ids_of(row)
