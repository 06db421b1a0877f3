"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from velotide.llm import near_dups
from velotide.llm.graph import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(map(repr, out))


def family(seed, n, words=120, edits=6):
    """An original and edited copies; some copies are edited further."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [base]
    for _ in range(n):
        new = list(rng.choice(out[:3]))
        for _ in range(rng.randint(1, edits)):
            new[rng.randrange(len(new))] = f"e{rng.randrange(10**6)}"
        out.append(new)
    return [" ".join(x) for x in out]


@pytest.fixture(scope="module")
def rows():
    texts = [t for s in range(6) for t in family(s, 25)] + family(99, 150, 60, 3)
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [shared + " " + t for t in family(7, 20, 40, 30)]
    return [(1000 - i if i % 3 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(
    "small, block", [(near_dups.SMALL, near_dups.BLOCK), (3, 4096), (3, 7)], ids=["whole", "rounds", "blocks"]
)
def test_equals_all_pairs(spark, rows, small, block, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    monkeypatch.setattr(near_dups, "SMALL", small)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.near_duplicates(docs).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_odd_rows(spark, odd_docs, odd_rows):
    got = sorted(repr(tuple(r)) for r in near_dups.near_duplicates(odd_docs).collect())
    pairs = [(r[0], r[1]) for r in odd_rows]
    want = brute(pairs)
    assert [g.replace("True", "1") for g in got] == [w.replace("True", "1") for w in want]


def test_rows_without_an_id_or_with_a_shared_one(spark):
    rows = [(None, t) for t in family(3, 12)] + [(7, t) for t in family(4, 12)] + [(1, family(3, 1)[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.near_duplicates(docs).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_one_of_each_keeps_the_columns(spark, odd_docs):
    left = near_dups.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=repr)
    assert ids == sorted([1, 2, 3, None, 4, 4, 5, 6, 9, 11, 12, 13], key=repr)


def test_one_of_each_tells_rows_apart_by_text(spark):
    near = family(5, 2, words=300, edits=1)
    other = " ".join(f"z{i}" for i in range(50))
    schema = "doc_id long, text string, lang string, source string"
    rows = [(3, near[0], "en", "b"), (4, other, "en", "a"), (4, near[1], "en", "a")]
    assert [tuple(r)[:2] for r in near_dups.one_of_each(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()] == [
        (3, near[0]), (4, other)
    ]
    rows = [(None, t, "en", "a") for t in near] + [(None, other, "en", "a"), (9, other, "en", "a")]
    left = near_dups.one_of_each(spark.createDataFrame(rows, schema)).collect()
    assert sorted((repr(r["doc_id"]), r["text"] in near) for r in left) == [("9", False), ("None", True)]
    rows = [(7, other, "fr", "b"), (7, other, "de", "z"), (7, other, "de", None), (8, None, "x", "y"), (8, None, "x", "y")]
    left = sorted(map(tuple, near_dups.one_of_each(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert left == [(7, other, "de", None), (8, None, "x", "y")]


def test_shingles_are_sets():
    assert len(near_dups.shingles(b"")) == 0
    assert len(near_dups.shingles(b" A ")) == 1
    assert near_dups.shingles(b"A b\tC").tolist() == near_dups.shingles(b"a B c").tolist()
    assert len(near_dups.shingles(b"x " * 50)) == 1


def test_estimates_lose_no_similar_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        sets = rng.integers(0, 2**63, 460).astype(np.uint64)
        a, b = np.sort(sets[:400]), np.sort(np.r_[sets[:340], sets[400:]])
        assert 100 * 340 >= 73 * 460
        x, y = (near_dups.odd_sketch(near_dups.samples(s)).view(np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= near_dups.LIMIT


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
