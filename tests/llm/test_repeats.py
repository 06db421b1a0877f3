"""Repeated passages against a count of all windows."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from velotide.llm import repeats


def brute(texts, length=repeats.LENGTH):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(t, mark, strict=True) if not m)
        spans = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((len(t), sum(mark), spans, hashlib.sha256(kept).hexdigest(), sum(mark) / max(len(t), 1)))
    return out


def test_longest_matches():
    rng = random.Random(3)
    for _ in range(100):
        text = np.array([rng.randrange(3) for _ in range(rng.randint(1, 50))] + [3])

        def common(a, b, text=text):
            k = 0
            while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            return k

        n = range(len(text))
        want = [max((common(a, b) for b in n if b != a), default=0) for a in n]
        assert repeats.longest_matches(text, 4).tolist() == want


@pytest.fixture(scope="module")
def texts(odd_rows):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(3000)]

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [some(90)[:n] for n in (399, 400, 401, 430, 500, 400, 450, 480)]
    out = [r[1] for r in odd_rows if not r[1] or len(r[1]) < 20_000]
    for _ in range(90):
        tail = rng.choice(["", "", passages[0][:399]])
        out.append(some(rng.randint(0, 60)) + rng.choice(passages) + some(rng.randint(0, 40)) + rng.choice(passages) + tail)
    # Periods, lengths about the limit, copies, and one passage in many surroundings.
    out += ["a" * 1500, "a" * 399, "a" * 400, "a" * 401, "ab" * 400, "The " * 500, "é" * 500]
    out += [out[-20], out[-20], out[-30] + "zzz"]
    out += ["q" * 10 + chr(97 + i % 7) * i + passages[1] for i in range(40)]
    return out


@pytest.mark.parametrize("many", [repeats.MANY, 2], ids=["index", "halving"])
def test_equals_brute_force(spark, texts, many, monkeypatch):
    monkeypatch.setattr(repeats, "MANY", many)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.report(docs).collect()}
    want = brute([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


def test_odd_rows(spark, odd_docs, odd_rows):
    got = sorted(map(repr, (tuple(r) for r in repeats.report(odd_docs).collect())))
    want = brute([(r[1] or "").encode()[:8000] if r[0] != 5 else b"" for r in odd_rows])
    long = odd_rows[7][1].encode()
    rows = [
        (r[0], *w) if r[0] != 5 else (5, len(long), 0, 0, hashlib.sha256(long).hexdigest(), 0.0)
        for r, w in zip(odd_rows, want, strict=True)
    ]
    assert got == sorted(map(repr, rows))


def test_batches_without_spans(spark, conf):
    """A task may meet batches with and without repeats, in any order."""
    conf(execution__arrow__maxRecordsPerBatch="1")
    passage = "".join(chr(97 + (i * i * 7 + i // 5) % 26) for i in range(500))
    texts = ["a", passage, "b", None, passage, "c"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r[0]: tuple(r)[1:] for r in repeats.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts])


def test_spans_and_kept_bytes(spark):
    a = "x" * 3 + "".join(chr(97 + (i * i) % 26) for i in range(450))
    docs = spark.createDataFrame([(1, a + "1"), (2, "ü" + a[3:])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in repeats.repeated(docs).collect()}
    assert [tuple(s) for s in rows[1]["spans"]] == [(3, 453)]
    assert bytes(rows[1]["kept"]) == b"xxx1"
    assert bytes(rows[2]["kept"]) == "ü".encode()


def passages_brute(texts, length=51):
    """1 for texts with ``length`` words in a row that another text has."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in texts]
    holders = collections.defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w) - length + 1):
            holders[tuple(w[k : k + length])].add(i)
    shared = {i for held in holders.values() if len(held) > 1 for i in held}
    return [int(i in shared) for i in range(len(texts))]


def test_passages_shorter_than_the_bytes(spark, odd_rows):
    """Passages of over 50 words of another text are told, though under 400 bytes go nowhere."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(3000)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    passages = [some(n) for n in (49, 50, 51, 52, 60, 75)]
    texts = [r[1] for r in odd_rows if not r[1] or len(r[1]) < 20_000]
    for passage in passages * 4:
        texts.append(rng.choice([" ", "\n", "  "]).join(some(rng.randint(0, 60)) + passage + some(rng.randint(0, 60))))
    # A passage that only its own text repeats, one word again and again, near copies, and many copies of a text.
    alone, copied = some(70), some(300)
    texts += [" ".join(alone + some(5) + alone), "of " * 50, "of " * 51, "of " * 400, "on " * 400]
    texts += [" ".join([*copied[:k], "x", *copied[k + 1 :]]) for k in range(0, 300, 45)]
    texts += [" ".join(copied[100:200])] * 5
    texts += [" ".join(some(9) + copied[i : i + 51] + some(9)) for i in range(0, 250, 7)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = [(t or "").encode() for t in texts]
    got = {r["doc_id"]: r for r in repeats.report(docs, passages=True).collect()}
    want = passages_brute(plain)
    assert [got[i]["shares_passage"] for i in range(len(texts))] == want
    assert [tuple(got[i])[1:-1] for i in range(len(texts))] == brute(plain)
    assert any(want[i] and not got[i]["n_removed"] for i in range(len(texts)))


def test_passages_of_rows_with_one_id(spark):
    """Rows that share an id or have none are told apart; the query has the column."""
    text = " ".join(f"w{i}" for i in range(51))
    docs = spark.createDataFrame([(1, text), (1, "x " + text), (None, text + " y"), (2, text[:-1])], "doc_id long, text string")
    rows = repeats.report(docs, passages=True).select("doc_id", "n_bytes", "shares_passage").collect()
    n = len(text)
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, [(1, n, 1), (1, n + 2, 1), (None, n + 2, 1), (2, n - 1, 0)]))


def test_groups_are_never_cut():
    keys = [1, 1, 2, 2, 2, 2, 2, 2, 3, 4]
    batches = [pa.RecordBatch.from_pydict({"key": keys[i : i + 2]}) for i in range(0, 10, 2)]
    parts = [p["key"].to_pylist() for p in repeats.whole_groups(iter(batches), "key", 3)]
    assert sum(parts, []) == keys
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert len(parts) > 1
