"""Near-duplicates by MinHash with odd sketches.

Each distinct shingle set gets MinHash samples.  Bands of samples bring sets
together that may be similar.  The samples, folded into a parity bitmap (an odd
sketch), estimate the similarity of two sets from the population count of the
XOR of their bitmaps; pairs that may reach the threshold are confirmed on the
full sets.

Sets that meet are not all paired with one another.  First each is tried with
the least set of its bucket.  After that only buckets in which components still
meet matter, and in them only pairs between components.  Small buckets name all
their likely pairs.  The sets of a large bucket go to tasks in blocks of bounded
size; a task joins components as it confirms pairs, and returns no more links
than it joins.  So no link between components is lost, while the rows made for a
group of copies grow with its size and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide.llm.common import mix, saved, text_function
from velotide.llm.graph import components

WORDS = 5
#: Similarity in hundredths.
THRESHOLD = 75
#: 32 bands of 4 samples: a pair at 0.75 misses all of them once in 190,000.
BANDS, ROWS = 32, 4
SAMPLES = 256
#: Bits of an odd sketch.
BITS = 512
#: Pairs estimated below this are not tried.  At similarity 0.75 the estimate's
#: standard deviation is 0.04 (samples 0.027, folding 0.03), so this is nearly 5 below.
ESTIMATE = 0.56
#: Buckets of up to so many sets name their likely pairs.
SMALL = 128
#: Larger ones are cut in blocks of about so many sets, and so many shingles, and
#: each two blocks are compared in a task.
BLOCK, BLOCK_SHINGLES = 4096, 2 << 20

_random = np.random.default_rng(20240229)
_MULTIPLY = _random.integers(0, 2**31, SAMPLES, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _random.integers(0, 2**32, SAMPLES, np.uint32)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    h = np.array([own[w] for w in words], np.uint64)
    n = min(WORDS, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(total)


def samples(sets: np.ndarray) -> np.ndarray:
    """The least value of the set under each of SAMPLES hash functions.

    The lower half of a shingle's hash serves one half of the functions, the
    upper half the other.
    """
    half = SAMPLES // 2
    low = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    halves = sets.view(np.uint32).reshape(-1, 2)
    for start in range(0, len(sets), 512):
        part = halves[start : start + 512]
        for k in range(2):
            own = slice(k * half, (k + 1) * half)
            values = part[:, k, None] * _MULTIPLY[own] + _ADD[own]
            values ^= values >> np.uint32(15)
            np.minimum(low[own], values.min(0), out=low[own])
    return low.astype(np.uint64)


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """A bitmap, as 64-bit words, with the parity of the samples that fall on each bit."""
    numbered = mix(low + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd = np.bincount((numbered % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low[: BANDS * ROWS].reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return total.view(np.int64)


def difference_limit() -> int:
    """Most differing bits with an estimate of at least ESTIMATE.

    n bits of which s samples' worth of differing elements are thrown at random
    have n (1 - (1 - 2/n)^d) / 2 odd ones, where d = 2 s (1 - similarity).
    """
    d = 2 * SAMPLES * (1 - ESTIMATE)
    return int(BITS * (1 - (1 - 2 / BITS) ** d) / 2)


LIMIT = difference_limit()


def _signed(texts: list[bytes]) -> dict:
    out: dict = {"n": [], "digest": [], "sketch": [], "bands": []}
    for t in texts:
        s = shingles(t)
        low = samples(s) if len(s) else None
        out["n"].append(len(s))
        out["digest"].append(digest(s) if len(s) else None)
        out["sketch"].append(odd_sketch(low) if len(s) else None)
        out["bands"].append(band_keys(low) if len(s) else None)
    return out


def digest(sets: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(sets.tobytes())


def signed(docs: DataFrame) -> DataFrame:
    """Per row doc_id, ``place`` (to find the row again), n (size of its set), digest,
    sketch and bands (NULL: empty set)."""
    run = text_function("n bigint, digest binary, sketch array<bigint>, bands array<bigint>", _signed)
    place = F.struct(F.xxhash64("text").alias("h"), "doc_id").alias("place")
    return docs.select("doc_id", place, run(F.col("text")).alias("s")).select("doc_id", "place", "s.*")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, hashes) for the sets in ``wanted`` (digest, place)."""

    def both(texts: list[bytes]) -> dict:
        sets = [shingles(t) for t in texts]
        return {"digest": [digest(s) for s in sets], "hashes": [s.tobytes() for s in sets]}

    run = text_function("digest binary, hashes binary", both)
    wanted = wanted.select(
        F.col("digest").alias("own"), F.col("place.h").alias("own_h"), F.col("place.doc_id").alias("own_id")
    )
    same = (F.xxhash64("text") == F.col("own_h")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    rows = docs.select("doc_id", "text").join(wanted, same)
    # Repeated rows bring a set more than once; it is kept once.
    return (
        rows.select("own", run(F.col("text")).alias("s"))
        .where(F.col("own") == F.col("s.digest"))
        .groupBy(F.col("own").alias("digest"))
        .agg(F.first("s.hashes").alias("hashes"))
    )


@F.pandas_udf(T.BooleanType())
def similar(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two sets, as sorted hashes, reach THRESHOLD."""
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
    return pd.Series(out, dtype=bool)


def tried(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``linked``: confirmed on the full sets."""
    one = sets.select(F.col("digest").alias("a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("digest").alias("b"), F.col("hashes").alias("y"))
    full = pairs.join(one, "a").join(two, "b")
    return saved(full.select("a", "b", similar("x", "y").alias("linked")), "tried-pairs")


def likely(n1, sketch1, n2, sketch2):
    """Whether two sets may reach the threshold, by their sizes and sketches."""
    bits = sum(F.bit_count(sketch1[k].bitwiseXOR(sketch2[k])) for k in range(BITS // 64))
    return (100 * F.least(n1, n2) >= THRESHOLD * F.greatest(n1, n2)) & (bits <= LIMIT)


class Members:
    """Rows of whole buckets, sorted by bucket."""

    def __init__(self, rows: pa.Table, place: list[str]):
        self.ids = rows["digest"].to_pylist()
        self.roots = pd.factorize(pd.Series(rows["root"].to_pylist()))[0]
        self.sizes = rows["n"].to_numpy()
        words = rows["sketch"].combine_chunks()
        self.words = words.flatten().to_numpy().view(np.uint64).reshape(len(self.ids), -1)
        at = [rows[c].to_numpy() for c in place]
        new = np.r_[True, np.any([c[1:] != c[:-1] for c in at], axis=0)]
        self.starts = np.flatnonzero(new)
        self.lengths = np.diff(np.r_[self.starts, len(self.ids)])

    def likely(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs, those between components that may reach the threshold, and their bits."""
        a, b = self.sizes[i], self.sizes[j]
        ok = (self.roots[i] != self.roots[j]) & (100 * np.minimum(a, b) >= THRESHOLD * np.maximum(a, b))
        i, j = i[ok], j[ok]
        bits = np.bitwise_count(self.words[i] ^ self.words[j]).sum(1)
        near = bits <= LIMIT
        return i[near], j[near], bits[near]

    def pairs(self) -> set[tuple[bytes, bytes]]:
        """All likely pairs of the buckets, a bucket size at a time."""
        found: set[tuple[bytes, bytes]] = set()
        for size in np.unique(self.lengths).tolist():
            one, two = np.triu_indices(size, 1)
            starts = self.starts[self.lengths == size]
            step = max(1, 1_000_000 // max(len(one), 1))
            for k in range(0, len(starts), step):
                base = starts[k : k + step, None]
                i, j, _ = self.likely((base + one).ravel(), (base + two).ravel())
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    a, b = self.ids[x], self.ids[y]
                    found.add((min(a, b), max(a, b)))
        return found

    def links(self, sets: list[np.ndarray], sides: np.ndarray | None) -> list[tuple[bytes, bytes]]:
        """Confirmed pairs that join the components of one bucket.

        ``sides``: where the rows are of two blocks, pairs within one are left out.
        """
        out, everyone = [], np.arange(len(self.ids))
        for most in (3, None):  # the likeliest partners first: they join most components
            for i in everyone.tolist():
                one, j, bits = self.likely(np.full(len(everyone), i), everyone)
                if sides is not None:
                    apart = sides[j] != sides[i]
                    j, bits = j[apart], bits[apart]
                if not len(j):
                    continue
                j = j[np.argsort(bits, kind="stable")[:most]]
                for k in j[similar_to(sets[i], [sets[k] for k in j.tolist()])].tolist():
                    if self.roots[k] != self.roots[i]:
                        self.roots[self.roots == self.roots[k]] = self.roots[i]
                        out.append((self.ids[i], self.ids[k]))
        return out


def similar_to(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the other sets reach THRESHOLD with the first."""
    sizes = np.array([len(x) for x in others])
    every = np.concatenate(others)
    held = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
    both = np.add.reduceat(held, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * both >= THRESHOLD * (len(one) + sizes - both)


def whole(batches: Iterator[pa.RecordBatch], place: list[str], least: int) -> Iterator[pa.Table]:
    """Sorted rows in runs of at least ``least`` that don't cut a bucket."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            rows = pa.Table.from_batches(held)
            same = np.all([rows[c].to_numpy() == rows[c][n - 1].as_py() for c in place], axis=0)
            cut = int(np.argmax(same))  # sorted, so the last bucket is a run at the end
            if cut:
                yield rows.slice(0, cut)
            held, n = rows.slice(cut).combine_chunks().to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)


def as_pairs(pairs) -> pa.RecordBatch:
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def meetings(buckets: DataFrame, info: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the small and the large buckets in which components meet."""
    placed = buckets.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    placed = placed.withColumn("root", F.coalesce("root", "digest")).join(info, "digest")
    mixed = (
        placed.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), F.sum("n").alias("held"))
        .where("low != high")
        .select("key", "size", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    rows = saved(placed.join(mixed, "key"), "meetings").select("key", "digest", "root", "n", "sketch", "size", "blocks")
    return rows.where(F.col("size") <= SMALL), rows.where(F.col("size") > SMALL)


def small_pairs(rows: DataFrame) -> DataFrame:
    """Distinct likely pairs (a, b) between components in small buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole(batches, ["key"], 50_000):
            yield as_pairs(sorted(Members(part, ["key"]).pairs()))

    rows = rows.select("key", "digest", "root", "n", "sketch").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "a binary, b binary").distinct()


def large_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components in large buckets."""
    place = ["key", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole(batches, place, 1):
            starts = [*Members(part, place).starts.tolist(), part.num_rows]
            for start, end in zip(starts, starts[1:], strict=False):
                own = part.slice(start, end - start)
                crossing = own["first"][0].as_py() != own["second"][0].as_py()
                full = [np.frombuffer(x, np.uint64) for x in own["hashes"].to_pylist()]
                yield as_pairs(Members(own, place).links(full, own["block"].to_numpy() if crossing else None))

    rows = rows.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    rows = rows.join(sets, "digest").select(*place, "block", "digest", "root", "n", "sketch", "hashes")
    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a binary, b binary")


def grouped(docs: DataFrame) -> DataFrame:
    """The rows of ``signed`` (doc_id, place, n, digest) with the ``root`` of their component, a
    digest, and its ``component_id``; both are NULL for an empty set."""
    docs = docs.select("doc_id", "text")
    rows = saved(signed(docs), "signed")
    info = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("place").alias("place"),
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
        F.first("bands").alias("bands"),
    )
    info = saved(info, "distinct-sets")
    met = info.select("digest", F.explode("bands").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("size"), F.min("digest").alias("hub")).where("size > 1")
    buckets = saved(met.join(shared.select("key", "hub"), "key"), "buckets")
    info = info.select("digest", "doc_id", "place", "n", "sketch")

    one = info.select(F.col("digest").alias("a"), F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    two = info.select(F.col("digest").alias("b"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    first = buckets.where("digest != hub").select(F.col("hub").alias("a"), F.col("digest").alias("b"))
    pairs = first.distinct().join(one, "a").join(two, "b")
    pairs = pairs.where(likely(F.col("n1"), F.col("s1"), F.col("n2"), F.col("s2"))).select("a", "b")

    wanted = buckets.select("digest").distinct().join(info.select("digest", "place"), "digest")
    sets = saved(full_sets(docs, wanted), "full-sets")
    done = tried(pairs, sets)
    found = done.where("linked").select("a", "b")
    roots = components(found.toDF("u", "v"))
    small, large = meetings(buckets.select("key", "digest"), info.select("digest", "n", "sketch"), roots)
    named = small_pairs(small).join(done, ["a", "b"], "left_anti")
    found = found.unionByName(tried(named, sets).where("linked").select("a", "b"))
    if not large.isEmpty():
        found = found.unionByName(saved(large_links(large, sets), "large-links"))
    roots = components(found.toDF("u", "v"))

    groups = info.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest")
    )
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = groups.select("digest", "root").join(least, "root").select("digest", "root", "component_id")
    return rows.select("doc_id", "place", "n", "digest").join(ids, "digest", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_shingles, component_id and kept.

    Rows are linked by their sets, so repeated rows and exact copies are one node.
    A NULL or empty text, or one without words, has an empty set and is its own
    component.  component_id is the least non-NULL doc_id of the component (of
    an empty set: the row's own); kept says that the row has it.
    """
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return grouped(docs).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the least doc_id, NULL counting as the greatest.

    Rows are told apart by id and text, so of texts that share an id each is
    judged by itself; of several in one component with the least id, the one
    with the least hash stays.  Texts without words stay.  Of rows of equal id and
    text, the one with the least other columns stays.
    """
    rows = grouped(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("place.h").alias("h"))).alias("f")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(first).select("f.doc_id", "f.h")
    empty = rows.where("root IS NULL").select("doc_id", F.col("place.h").alias("h")).distinct()
    kept = least.unionByName(empty).select(F.col("doc_id").alias("_kept_id"), F.col("h").alias("_kept_h"))
    same = (F.xxhash64("text") == F.col("_kept_h")) & F.col("doc_id").eqNullSafe(F.col("_kept_id"))
    rows = docs.join(kept, same, "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return rows.distinct()
    once = rows.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("_others"))
    return once.select(*[c if c in ("doc_id", "text") else F.col("_others")[c].alias(c) for c in docs.columns])
