"""Extendible hashing."""

import collections

import pytest
from pyspark.sql import functions as F

from velotide.llm import shards


def tries(rows, limit):
    """The directory as a plain trie: bits to bucket."""
    buckets = {}

    def place(own, depth, prefix):
        size = sum(s for _, s in own)
        if not own:
            return
        if size <= limit or depth == shards.BITS:
            buckets[prefix] = own
            return
        for bit in "01":
            place([x for x in own if x[0][depth] == bit], depth + 1, prefix + bit)

    place(rows, 0, "")
    return buckets


@pytest.mark.parametrize("limit, step", [(10**9, 12), (5000, 12), (700, 2), (50, 3)])
def test_equals_a_plain_trie(spark, limit, step):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('x', int(id % 90)) AS text")
    bits = docs.select("doc_id", shards.hash_bits("doc_id", "text").alias("bits"), "text").collect()
    rows = [(format(r["bits"], "060b"), len(r["text"])) for r in bits]
    want = tries(rows, limit)
    hashed = spark.createDataFrame([(int(b, 2), s) for b, s in rows], "bits long, size long")
    got = {
        format(r["prefix"], f"0{r['depth']}b") if r["depth"] else "": (r["bytes"], r["n_docs"])
        for r in shards.directory(hashed, limit, step).collect()
    }
    assert got == {k: (sum(s for _, s in v), len(v)) for k, v in want.items()}


def test_shards_fit_and_hold_all_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shards.assign(docs, 100_000).collect()
    assert len(rows) == 1000
    size = collections.Counter()
    count = collections.Counter()
    for r in rows:
        size[r["shard"]] += r["bytes"]
        count[r["shard"]] += 1
    assert all(s <= 100_000 or count[k] == 1 for k, s in size.items())
    # A bucket split only because the one above it was too large.
    above = collections.Counter()
    for k, s in size.items():
        above[k[:-1]] += s
    for k in size:
        total = sum(s for other, s in size.items() if other.startswith(k[:-1]))
        assert not k or total > 100_000


def test_repeated_rows_beyond_the_limit(spark, odd_docs, odd_rows):
    rows = shards.assign(odd_docs, 300).collect()
    assert len(rows) == len(odd_rows)
    copies = spark.createDataFrame([(1, "x" * 100)] * 25 + [(2, "y")], "doc_id long, text string")
    rows = shards.assign(copies, 1000).collect()
    size = collections.Counter()
    for r in rows:
        size[r["shard"]] += r["bytes"]
    assert len(rows) == 26
    assert max(size.values()) <= 1000


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    shards.write_shards(docs, 100_000, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(docs.columns).exceptAll(docs).isEmpty()
    assert back.count() == docs.count()
    assert back.select("shard").distinct().count() > 3


def test_written_rows_are_told_apart_by_row(spark, tmp_path, odd_docs):
    """Two texts an id, rows without id, repeated rows: each row is written once."""
    rows = [(i // 2, f"text {i} " * 5) for i in range(200)] + [(None, "no id"), (None, "no id"), (None, None)]
    rows += [(500, "x" * 100)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, some in (("own", docs), ("odd", odd_docs.withColumn("shard", F.lit("x")))):
        shards.write_shards(some, 300, str(tmp_path / name))
        back = spark.read.schema(some.schema).parquet(str(tmp_path / name))
        columns = [c for c in some.columns if c != "shard"]
        assert sorted(map(repr, back.select(columns).collect())) == sorted(map(repr, some.select(columns).collect()))
