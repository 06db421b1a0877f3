"""Context-tree weighting against its definition."""

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from velotide.llm import ctw


def definition(train, text, depth=ctw.DEPTH):
    """log10 of the probability of ``text`` after ``train``, node by node."""
    end = bytes([ctw.END])
    counts = {}

    def bits(t):
        t = end * depth + t.lower() + end
        for i in range(depth, len(t)):
            for k in range(8):
                yield t[i - depth : i], (t[i] >> (8 - k), k), t[i] >> (7 - k) & 1

    for t in train:
        for context, place, bit in bits(t):
            for d in range(depth + 1):
                counts.setdefault((context[depth - d :], place), [0, 0])[bit] += 1

    def own(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}
    longer = {}
    for context, place in counts:
        if context:
            longer.setdefault((context[1:], place), []).append(context)

    def weighted(context, place):
        key = (context, place)
        if key not in memo:
            alone = own(*counts[key])
            if len(context) < depth:
                below = sum(weighted(c, place) for c in longer.get(key, []))
                alone = math.log(0.5) + np.logaddexp(alone, below)
            memo[key] = alone
        return memo[key]

    total = 0.0
    for context, place, bit in bits(text):
        p, left = 0.0, 1.0
        for d in range(depth + 1):
            key = (context[depth - d :], place)
            a, b = counts.get(key, (0, 0))
            share = 1.0
            if d < depth:
                share = math.exp(math.log(0.5) + own(a, b) - weighted(*key)) if key in counts else 0.5
            p += left * share * (b + 0.5) / (a + b + 1)
            left *= 1 - share
        total += math.log10(p if bit else 1 - p)
    return total


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check(spark, rows, docs):
    got = ctw.score(docs).collect()
    assert len(got) == len(rows)
    own = [(r[0], (r[1] or "").encode()) for r in rows]
    train = [t for i, t in own if not fold(i)]
    counts = Counter(w for t in train for w in [*t.lower().split(), b""])
    total, kinds = sum(counts.values()), len(counts)
    want = {}
    for i, t in own:
        held = [*t.lower().split(), b""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in held)
        want.setdefault((i, len(t)), []).append((fold(i), len(held), sum(w in counts for w in held), base, t))
    for r in got:
        held_out, n, known, base, t = want[r["doc_id"], r["n_bytes"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        if len(t) < 3000:
            assert r["score"] == pytest.approx(definition(train, t), rel=1e-8)


def test_equals_the_definition(spark, monkeypatch):
    rows = [(i, f"The cat{'s' * (i % 3)} sat on mat {i * i % 17}. é\n" * (i % 4)) for i in range(40)]
    check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_odd_rows(spark, odd_rows):
    rows = [(r[0], r[1] if r[1] is None else r[1][:400]) for r in odd_rows]
    check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_clashing_columns(spark, odd_docs, odd_rows):
    assert ctw.score(odd_docs).count() == len(odd_rows)


def test_blocks_and_tasks_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {r["doc_id"]: r for r in ctw.score(docs).collect()}
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 1 << 17)
    monkeypatch.setattr(ctw, "GRAMS_PER_TASK", 5000)
    for r in ctw.score(docs).collect():
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"], rel=1e-9)
        assert r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"], rel=1e-9)


def test_probabilities_add_up_to_one():
    """Of the next byte, after any context."""
    texts = [b"abracadabra", b"cadabra abra", b"dab"]
    keys, counts = ctw.distinct(texts, [True] * 3)
    context = keys[len(keys) // 2] >> 8
    every = (context << 8) | np.arange(256)
    keys, counts = ctw.added(np.r_[keys, every], np.r_[counts, np.zeros(256, np.int64)])
    levels = ctw.forest(keys, counts, 2)
    sums = [
        pd.DataFrame({"bits": b, "key": ctw.parent(n.keys, 2, b), "n0": n.n0, "n1": n.n1, "below": n.weighted})
        for b, n in enumerate(levels[0].nodes)
    ]
    top = ctw.Top(pd.concat(sums).groupby(["bits", "key"], as_index=False).sum())
    values = ctw.log10_probabilities(levels, top)
    assert sum(10 ** values[np.searchsorted(keys, every)]) == pytest.approx(1, abs=1e-12)


def test_held_out_texts_beat_the_words_alone(spark):
    rows = ctw.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**48, 5000))
    table = ctw.Lookup(keys, keys / 7)
    asked = rng.choice(keys, 20_000)
    assert (table.get(asked) == asked / 7).all()


def test_log_gamma():
    twice = np.array([1, 2, 3, 100, 4095, 4096, 4097, 10**6, 10**12])
    want = [math.lgamma(x / 2) for x in twice]
    assert ctw.lgamma_half(twice) == pytest.approx(want, rel=1e-12)
