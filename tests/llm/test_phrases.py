"""Phrases against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from velotide.llm import phrases


def brute(rows, threshold, top):
    """Rows of (lang, text) to (lang, rank, phrase, a, l, r, n, score)."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        rows = []
        for p, a in often.items():
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()
            )
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def mined(spark, rows, threshold, top=2000, parts=4):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(map(tuple, phrases.collocations(docs, threshold, top).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["New", "York", "é", "日本", "x y", "\x1c"]
    ends = [" ", " ", " ", " ", ", ", ". ", "\n", "\t", "; ", "\r\n", "  "]
    out = []
    for i in range(150):
        words = [rng.choice(vocabulary[: 5 + rng.randrange(42)]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice(ends) for w in words) + "in New York City we trust! " * (i % 3)
        out.append((rng.choice(["en", "de", None, "und"]), text))
    return [*out, ("en", None), ("en", ""), (None, " \t\n"), ("fr", "few words only"), ("xx", None)]


@pytest.mark.parametrize("threshold, top", [(3, 2000), (12, 7), (100, 2000)])
def test_equals_plain_counting(spark, rows, threshold, top):
    want = brute(rows, threshold, top)
    assert mined(spark, rows, threshold, top) == want
    assert want or threshold == 100


def test_small_blocks_and_parts(spark, rows, monkeypatch):
    """Many summaries are merged, with far fewer counters than n-grams."""
    monkeypatch.setattr("velotide.llm.blocks.ROW_BYTES", 1 << 20)
    monkeypatch.setattr(phrases, "PART_BYTES", 5_000)
    monkeypatch.setattr(phrases, "CHUNK", 50)
    assert mined(spark, rows, 12) == brute(rows, 12, 2000)


def test_one_hot_phrase(spark):
    rows = [("en", "of the world") for _ in range(500)] + [("en", f"a{i} the world") for i in range(30)]
    assert mined(spark, rows, 20) == brute(rows, 20, 2000)


def test_products_beyond_64_bits(spark):
    f = 2_000_000_000_000
    grams = spark.createDataFrame([("en", "a", 1, f), ("en", "b", 1, f + 1), ("en", "a b", 2, f - 1)], phrases.COUNTS)
    n = spark.createDataFrame([("en", 10**15)], "lang string, n bigint")
    (row,) = phrases.scored(grams, n).collect()
    assert row.score == 1000 * (f - 1) * 10**15 // (f * (f + 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 30), st.integers(1, 20), max_size=12), max_size=12), st.integers(2, 40))
def test_every_frequent_key_survives(summaries, threshold):
    true = Counter()
    for s in summaries:
        true.update(s)
    sketch = phrases.MisraGries(sum(true.values()) // threshold + 1)
    for s in summaries:
        keys = sorted(s)
        sketch.add(np.array(keys, np.uint64), np.array([s[k] for k in keys], np.int64))
        assert len(sketch.keys) <= sketch.k and sketch.n_waiting < sketch.k
    sketch.merge()
    assert len(sketch.keys) <= sketch.k
    held = dict(zip(sketch.keys.tolist(), sketch.counts.tolist(), strict=True))
    assert sketch.taken < threshold
    assert all(0 <= n - held.get(k, 0) <= sketch.taken for k, n in true.items())
    assert {k for k, n in true.items() if n >= threshold} <= set(sketch.may_reach(threshold).tolist())


def test_odd_rows(spark, odd_docs, odd_rows):
    got = sorted(map(tuple, phrases.collocations(odd_docs, 3).collect()))
    assert got == brute([(r[2], r[1]) for r in odd_rows], 3, 2000)


def test_no_rows(spark, no_docs):
    assert phrases.collocations(no_docs).collect() == []
