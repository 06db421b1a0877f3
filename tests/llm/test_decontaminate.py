"""Benchmark passages against edit distance at every place."""

import random

import numpy as np
import pytest

from velotide.llm import decontaminate as d


def distance_to_any_stretch(item, words):
    """Least edit distance of item to a stretch of words, by the whole table."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(words, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b)))
    return min(row)


def test_nearest():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 70))]
        words = [rng.randrange(5) for _ in range(rng.randint(0, 60))]
        assert d.nearest(item, words)[0] == distance_to_any_stretch(item, words)


def edited(rng, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(words))
        if kind < 1 / 3:
            words[at] = rng.choice(vocabulary)
        elif kind < 2 / 3:
            words.insert(at, rng.choice(vocabulary))
        else:
            del words[at]
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in range(40)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(40)]
    docs = []
    for _ in range(400):
        item = rng.choice(items)
        edits = rng.randint(0, d.allowed(len(item)) + 3)
        front, back = ([rng.choice(vocabulary) for _ in range(rng.randint(0, 50))] for _ in range(2))
        docs.append(front + edited(rng, item, vocabulary, edits) + back)
    docs += [[rng.choice(vocabulary) for _ in range(120)] for _ in range(100)]
    return items, docs


def test_recall_against_brute_force(corpus):
    items, docs = corpus
    index = d.Items([(i, " ".join(x).encode()) for i, x in enumerate(items)])
    got = index.matches([(" ".join(x) + ".").encode() for x in docs])
    found = {(i, m["item_id"]) for i, ms in enumerate(got) for m in ms}
    want = {
        (i, k)
        for i, words in enumerate(docs)
        for k, item in enumerate(items)
        if len(set(item) & set(words)) > len(item) // 3
        and distance_to_any_stretch(item, words) <= d.allowed(len(item))
    }
    assert found <= want
    assert len(found) >= 0.97 * len(want)
    assert len(want) > 250


def test_windows_lose_nothing(corpus):
    """A stretch within the limit starts at a window that is embedded."""
    items, docs = corpus
    index = d.Items([(i, " ".join(x).encode()) for i, x in enumerate(items)])
    rng = random.Random(5)
    for item in items:
        size = len(item)
        words = edited(rng, item, ["unseen"], d.allowed(size))
        symbols = np.array([index.vocabulary.get(w.encode(), 0) for w in words])
        starts = {length: set(at.tolist()) for length, at in index.windows(symbols)}
        assert min(starts[size]) <= d.allowed(size)


def test_rows(spark, odd_docs):
    benchmark = spark.createDataFrame(
        [(1, "One"), (2, None), (3, ""), (None, "hunter2hunter é token"), (4, "the the the the the the the the"), (4, "ONE!")],
        "item_id long, text string",
    )
    got = d.contaminations(odd_docs, benchmark).select("doc_id", "item_id").collect()
    want = [(9, 1), (10, 1), (9, 4), (10, 4), (11, 4), (13, None)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    left = d.clean(odd_docs, benchmark)
    assert left.columns == odd_docs.columns
    assert left.count() == odd_docs.count() - 4


def test_items_in_blocks(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, d.contaminations(docs, benchmark).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 3000)
    assert len(list(d.blocks(benchmark))) > 2
    assert sorted(map(tuple, d.contaminations(docs, benchmark).collect())) == whole
    assert len(whole) > 10
    assert d.clean(docs, benchmark).count() == 1000 - len({r[0] for r in whole})


def test_ids_of_any_type(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([("d", f"before {item} after"), ("e", "else")], "doc_id string, text string")
    items = spark.createDataFrame([("i1", item)], "item_id string, text string")
    assert [tuple(r) for r in d.contaminations(docs, items).collect()] == [("d", "i1", 0, 31)]
    assert [r["doc_id"] for r in d.clean(docs, items).collect()] == ["e"]
