"""Near duplicates against comparing all pairs of sets."""

import random
import re

import numpy as np
import pytest

from vaultwatch.llm import minhash_dedup as near


def shingles(text, width):
    if not text:
        return frozenset()
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1)))


def brute(rows, width, percent=80):
    sets = [shingles(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(r[0], smallest.get(find(i), r[0]))
    out = []
    for i, r in enumerate(rows):
        component = smallest.get(find(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=str)


def corpus(seed, docs=60):
    """Chains of edited copies around the limit, shared passages, short texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "THE"]
    passage = rnd.choices(vocabulary, k=60)
    texts = []
    for _ in range(docs // 6):
        base = rnd.choices(vocabulary, k=rnd.choice([3, 12, 40, 150, 400]))
        texts.append(base)
        for _ in range(5):
            base = list(base)
            for _ in range(rnd.randrange(0, max(1, len(base) // 9))):
                base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            texts.append(base if rnd.random() < 0.8 else passage + base)
    rows = [(i * 7 % 1009, rnd.choice(["  ", " ", "\n"]).join(t), "clash") for i, t in enumerate(texts)]
    rows += [(2001, None, None), (2002, "", None), (2003, " \n ", None), (2004, "one", None), (2005, "ONE ", None), (2006, "one two", None), (None, "one", None), (None, None, None), (2004, "one", None)]
    return rows


@pytest.mark.parametrize("seed,width", [(1, 2), (2, 5), (3, 2)])
def test_same_components_as_all_pairs(spark, seed, width):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(5)
    got = sorted((tuple(r) for r in near.link(docs, width=width).collect()), key=str)
    assert got == brute(rows, width)


@pytest.mark.parametrize("size", range(5))
def test_few_words_in_all(size):
    words = [f"w{i}" for i in range(size)]
    found = list(near.shingle_sets(*near.text_bytes(near.pa.array([" ".join(words)])), 5))
    padded = list(near.shingle_sets(*near.text_bytes(near.pa.array([" ".join(words), "more words than a run of five has"])), 5))
    assert [len(s) for s in found] == [min(1, size)] and found[0].tolist() == padded[0].tolist()


def test_few_words_in_a_partition_of_their_own(spark):
    texts = ["one", "one two", "one two three", "one two three four", "one two", None, ""]
    parts = [spark.createDataFrame([(i, t)], "doc_id long, text string").coalesce(1) for i, t in enumerate(texts)]
    docs = parts[0]
    for part in parts[1:]:
        docs = docs.unionByName(part)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.link(docs).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 1), 5: (0, 5), 6: (0, 6)}


def test_empty_table(spark):
    assert near.link(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_large_group_of_copies(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(300)}" for _ in range(300)]
    rows = [(i, " ".join(base[: i % 3] + base), None) for i in range(300)]
    rows += [(1000 + i, " ".join([*base[:280], *(f"x{i}y{j}" for j in range(10))]), None) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((tuple(r) for r in near.link(docs, width=2).collect()), key=str)
    assert got == brute(rows, 2)


def test_estimate_of_whole_sets_is_exact():
    a, b = np.array([[1, 2, 3, 2**64 - 1]], np.uint64), np.array([[2, 3, 5, 9]], np.uint64)
    assert near.estimate(a, b, np.array([3]), np.array([4]), 4).tolist() == [2 / 5]


def test_listed_values_cover_the_limit():
    for n in range(1, 200):
        kept = near.prefix(n, 64, 80)
        assert 1 <= kept <= min(n, 64)


def thue_morse(order):
    word, other = b"a", b"b"
    for _ in range(order):
        word, other = word + other, other + word
    return word.decode(), other.decode()


def test_words_made_to_share_a_polynomial_hash(spark):
    """Two words of 2,048 bytes, and of 1,024, that are all the difference of four texts."""
    words = [*thue_morse(11), *thue_morse(10)]
    rows = [(i, f"{w} stands in this text {w}", None) for i, w in enumerate(words)] + [(9, f"{words[1]} stands in this text {words[1]}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted((tuple(r) for r in near.link(docs, width=2).collect()), key=str) == brute(rows, 2)


def test_a_collision_of_hashes_links_nothing(spark, monkeypatch):
    assert near.similar("a b c d", "A b  c d", 2, 80) and not near.similar("a b c d", "a b c x", 2, 80)
    assert near.similar("a", "A", 2, 80) and not near.similar("a", "a b", 2, 80) and not near.similar("", " ", 2, 80)


@pytest.mark.parametrize("size,block", [(400, 2048), (400, 64), (60, 8)])
def test_a_crowd_just_below_the_limit(spark, size, block):
    """All pairs are a little less alike than asked, but for some planted links that no drawn head need show."""
    rnd = random.Random(size + block)
    base = [f"w{i}" for i in range(60)]

    def text(seed):
        r, words = random.Random(seed), list(base)
        for at in r.sample(range(60), 6):
            words[at] = f"x{seed}y{at}"
        return words

    rows = [(i, " ".join(text(i)), None) for i in range(size)]
    for i in rnd.sample(range(size), size // 10):
        words = text(i)
        words[rnd.randrange(60)] = f"z{i}"
        rows.append((10_000 + i, " ".join(words), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted((tuple(r) for r in near.link(docs, width=2, block=block).collect()), key=str)
    want = brute(rows, 2)
    assert got == want and 0 < sum(not r[3] for r in want) < size


def test_long_sets_are_decided_in_full(spark):
    """Sets beyond the wide sketch, around the limit."""
    rnd = random.Random(8)
    base, rows = [f"w{i}" for i in range(1500)], []
    for i, changed in enumerate([0, 60, 80, 83, 84, 90, 100, 200, 70, 75, 81, 82]):
        words = list(base)
        for at in rnd.sample(range(0, 1500, 2), changed):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((tuple(r) for r in near.link(docs, width=2).collect()), key=str)
    assert got == brute(rows, 2)


def test_very_long_texts(spark):
    rnd = random.Random(9)
    words = rnd.choices([f"w{i}" for i in range(5000)], k=600_000)
    near_copy = words[:-20_000] + rnd.choices(words, k=20_000)
    rows = [(1, " ".join(words), None), (2, " ".join(near_copy), None), (3, " ".join(words[:400_000]), None), (4, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted((tuple(r) for r in near.link(docs).collect()), key=str) == brute(rows, 5)


def test_block_links_equal_all_pairs():
    rnd = np.random.default_rng(10)
    for trial in range(20):
        size = 40
        base = rnd.choice(10**6, 30, replace=False).astype(np.uint64)
        wide = [np.unique(np.append(rnd.choice(base, 26, replace=False), rnd.integers(0, 10**6, rnd.integers(0, 5)).astype(np.uint64))) for _ in range(size)]
        n = np.array([len(w) for w in wide])
        node, root, part = np.arange(size), np.arange(size), np.zeros(size, int)
        links, open_ = near.block_links(node, n, root, part, [w[:5] for w in wide], wide, 80)
        joined = near._Joined(root)
        for x, y in links:
            joined.join(x, y)
        want = near._Joined(root)
        for x in range(size):
            for y in range(x):
                both = len(np.intersect1d(wide[x], wide[y]))
                if len(np.intersect1d(wide[x][:5], wide[y][:5])) and 100 * both >= 80 * (n[x] + n[y] - both):
                    want.join(x, y)
        assert not open_ and len(links) < size
        assert [joined.find(i) for i in range(size)] == [want.find(i) for i in range(size)]
