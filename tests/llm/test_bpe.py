"""The encoder against the tiktoken library."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from vaultwatch.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.encoder(PATH, P.PATTERN).vocabulary.ranks
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(5)
    made = ["".join(rnd.choice("ab é日\n'st0,|") for _ in range(rnd.randrange(400))) for _ in range(40)]
    return [None, "", " ", "a" * 3000, "the" * 200, "\U0001f600" * 50, "x" * 63, "x" * 64, "x" * 65, "<|endoftext|> it's", *made]


def test_same_ids_as_the_library(library):
    texts = odd_texts()
    tool = bpe.Encoder(bpe.Vocabulary.read(PATH, P.PATTERN))
    for text, ids in zip(texts, tool.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text or "")
        assert tool.vocabulary.decode(ids) == (text or "").encode()


def test_narrow_and_wide_matrices_agree():
    tool = bpe.encoder(PATH, P.PATTERN).vocabulary
    rnd = random.Random(8)
    rows = ["".join(rnd.choice("etaoin shrdlu") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(300)]
    assert [a.tolist() for a in tool._matrix(rows)] == [a.tolist() for a in tool._wide(rows)]


def test_long_pieces(library):
    rnd = random.Random(9)
    alphabets = ["a", "ab", "the", "etaoinshrdlu", "日本語中文字", "=-*/", "éèüß", "aA", "\U0001f600\U0001f601"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice([65, 90, 300, 2000]))) for letters in alphabets for _ in range(12)]
    texts += [" " * 5000 + "x", "the" * 40_000, "".join(rnd.choice("etaoinshrdlu") for _ in range(100_000))]
    tool = bpe.Encoder(bpe.Vocabulary.read(PATH, P.PATTERN))
    for text, ids in zip(texts, tool.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)


def test_merges_that_bring_about_a_lower_rank():
    """A vocabulary whose ranks do not rise with the merges, against merging the leftmost lowest pair step by step."""
    rnd = random.Random(10)
    tokens = {bytes([b]): b for b in range(256)}
    made = {bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 6))) for _ in range(120)}
    tokens |= dict(zip(sorted(made, key=lambda t: rnd.random()), range(256, 1000)))
    tool = bpe.Vocabulary(tokens, r"\S+")

    def brute(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            found = [(tokens[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in tokens]
            if not found:
                return [tokens[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rows = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 120))) for _ in range(400)]
    assert [a.tolist() for a in tool._wide(rows)] == [brute(r) for r in rows]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    tool = bpe.Encoder(bpe.Vocabulary.read(PATH, P.PATTERN))
    for part in (odd_texts()[:20], odd_texts()[20:]):
        for text, ids in zip(part, tool.encode(part)):
            assert ids.tolist() == library.encode_ordinary(text or "")


def test_tables(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts())] + [(None, "null key", "x"), (3, "again", None), (3, "again", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = sorted((str(i), ",".join(map(str, library.encode_ordinary(t or "")))) for i, t, _ in rows)
    coded = bpe.encode(docs, PATH, P.PATTERN).collect()
    assert sorted((str(r.doc_id), ",".join(map(str, r.ids))) for r in coded) == want
    assert sorted(bytes(r.decoded) for r in coded) == sorted((t or "").encode() for _, t, _ in rows)
    found = bpe.digests(docs, PATH, P.PATTERN).collect()
    assert sorted((str(r.doc_id), r.ids_sha256) for r in found) == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in want)
    assert sum(r.n_tokens for r in found) == sum(len(t.split(",")) for _, t in want if t)
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).collect() == []
