"""The pipeline against a plain version of each stage."""

import re

import pytest
from test_bpe import expected
from test_decontaminate import distance_to_any_stretch
from test_near_dups import shingle_set

import corpus_pipeline
from velotide.llm import decontaminate, neighbours

SF = "/root/testdata/sf0.001"


def plain_near_dups(rows):
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [r for r in rows if find(r["doc_id"]) == r["doc_id"]]


def contaminated(text, items):
    words = decontaminate.words_of(text.encode())
    have = set(words)
    return any(
        len(have & set(i)) >= len(set(i)) // 2 and distance_to_any_stretch(i, words) <= decontaminate.allowed(len(i))
        for i in items
    )


SECRET = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})"""
    r"""|(AKIA[A-Z0-9]{16,})|([0-9a-f]{24,})""",
    re.ASCII,
)


def test_pipeline(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = neighbours.fit(docs, labels)
    rows = docs.collect()
    scores = model.scores([r["text"].encode() for r in rows])
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.5]
    rows = plain_near_dups(rows)
    items = [decontaminate.words_of(r["text"].encode()) for r in benchmark.collect()]
    rows = [r for r in rows if not contaminated(r["text"], items)]
    owners, repos = {}, {}
    for r in rows:  # no two have one text here, so each is a repository
        for m in SECRET.finditer(r["text"]):
            owners.setdefault(m[1] or m[2] or m[3], set()).add(r["source"])
            repos.setdefault(m[1] or m[2] or m[3], set()).add(r["doc_id"])

    def redacted(text):
        def mark(m):
            value = m[1] or m[2] or m[3]
            example = (len(owners[value]) > 2 and len(repos[value]) > 10) or len(repos[value]) > 1000
            live = not example and re.search("[0-9]", value) and re.search("[A-Za-z]", value)
            return "[secret]" if live else m[0]

        return SECRET.sub(mark, text)

    want = {r["doc_id"]: redacted(r["text"]) for r in rows}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert 0 < len(want) < docs.count()
    for i, r in got.items():
        assert list(r["ids"]) == expected(want[i])
        assert r["n_tokens"] == len(r["ids"])
        assert r["n_chars"] == len(want[i])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_no_rows(spark, odd_docs, no_docs, name, stage):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs.select(columns), no_docs, odd_docs):
        out = stage(spark, docs, SF)
        own = [c for c in docs.columns if c != "ids" or name != "bpe_encoding"]
        assert out.columns[: len(own)] == own
        assert out.count() <= docs.count()
    if name not in ("quality_classifier", "minhash_near_dedup"):
        assert stage(spark, odd_docs, SF).count() == odd_docs.count()
