"""Similarity join of shingle sets by vertical partitioning.

The global order of shingles is by rarity: first the level of a shingle (the bit
length of how many rows hold it), then its hash.  A set is a sorted array of such
keys.  Cuts in that order make fragments; a set's keys in one are its segment.  The
overlap of two sets is counted fragment by fragment and summed per pair.

Which pairs are counted: sets that reach the threshold share one of the first keys
of both (their prefix), and what follows there must be long enough.  Keys bring sets
together in buckets; buckets of the same members are one.  In each round, a few hubs
of every bucket are tried with its other members.  Then components are joined, the
hubs leave the bucket, and buckets within one component are done.  Each round has
more hubs, and a bucket with no more members than hubs tries all that is left.  So
every pair that might link is tried, unless its sets are joined by then, and rows
grow with a bucket's size times the hubs, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.blocks import blocks, pack_numbers, pack_sorted, parts_of, unpack_numbers, unpack_sorted
from velotide.llm.common import mix, pack, raw, saved, text_bytes, unpack
from velotide.llm.graph import components

WORDS = 5
#: Similarity in hundredths.
THRESHOLD = 80
#: Fragments of the global order.
FRAGMENTS = 4
#: Hubs of a bucket in the first round, and how many times more in each after it.
HUBS, MORE = 1, 256
#: Sets compared with one hub in a task.
PER_TASK = 4096
#: Bytes of text for a part of the hashes.
PART_BYTES = 4 << 20
#: A key: its level above so many bits of its hash.
HASH_BITS = 58
#: Cells of a level, in the counts that place the cuts.
CELLS = 16


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of runs of WORDS words; a text of fewer words is one run."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = {w: xxhash.xxh3_64_intdigest(w, WORDS) for w in set(words)}
    h = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(h))
    total = h[: len(h) - size + 1] + np.uint64(size)
    for k in range(1, size):
        total = mix(total * np.uint64(0xD1342543DE82EF95) + h[k : len(h) - size + 1 + k])
    return np.unique(mix(total))


def overlap_of(n: int) -> int:
    """Shingles a set of ``n`` shares with any set it is linked to, at least."""
    return -(-THRESHOLD * n // 100)


# -- the global order ------------------------------------------------------------

BLOCK = "block bigint, part bigint, data binary, ids array<{id}>, counts binary"
#: In place of a part, for the texts of a block.
TEXTS = -1


def batch(rows: list[dict], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def held_hashes(sets: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading bits of all hashes, ascending, with the number of rows that hold them.

    The order may be any function of a shingle; with some bits more than there are
    shingles few look more frequent than they are.
    """
    every = np.concatenate([*sets, np.empty(0, np.uint64)])
    return np.unique(every >> np.uint64(64 - bits), return_counts=True)


def hashed_blocks(docs: DataFrame, bits: int, shift: int) -> DataFrame:
    """The texts of each block with their ids, and its hashes with their counts, by part."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None
        for number, rows in blocks(batches):
            texts = rows["text"].to_pylist()
            fields = fields or [
                ("block", pa.int64()), ("part", pa.int64()), ("data", pa.binary()),
                ("ids", pa.list_(rows["doc_id"].type)), ("counts", pa.binary()),
            ]
            sizes = np.array([len(t) for t in texts])
            own = {"block": number, "part": TEXTS, "ids": rows["doc_id"].to_pylist()}
            yield batch([own | {"data": pack(b"".join(texts)), "counts": pack_numbers(sizes)}], fields)
            hashes, counts = held_hashes([shingles(t) for t in texts], bits)
            parts, at = parts_of(hashes, shift)
            out = [
                {"block": number, "part": p, "data": pack_sorted(hashes[i:j]), "counts": pack_numbers(counts[i:j])}
                for p, i, j in zip(parts.tolist(), at.tolist(), at[1:].tolist(), strict=False)
            ]
            for i in range(0, len(out), 256):
                yield batch(out[i : i + 256], fields)

    rows = docs.select("doc_id", raw(F.col("text")).alias("text"))
    return saved(rows.mapInArrow(run, BLOCK.format(id=id_type)), "hashed-blocks")


def levels(hashed: DataFrame) -> DataFrame:
    """(block, part, levels): for each hash of a block and part, the bit length of its number of rows."""

    def run(part: pa.Table) -> pa.Table:
        own = [(unpack_sorted(d), unpack_numbers(c)) for d, c in zip(part["data"], part["counts"], strict=True)]
        every, at = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([c for _, c in own]), minlength=len(every))
        level = np.frexp(total)[1].astype(np.uint8)  # 1 for one row, 2 for two or three, ...
        sizes = np.cumsum([len(k) for k, _ in own])[:-1]
        told = [pack(x.tobytes()) for x in np.split(level[at], sizes)]
        return pa.table({"block": part["block"], "part": part["part"], "levels": pa.array(told, pa.binary())})

    rows = hashed.where(F.col("part") != TEXTS).select("block", "part", "data", "counts")
    return rows.groupBy("part").applyInArrow(run, "block bigint, part bigint, levels binary")


def ordered_sets(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n (size of its set), digest, and ``keys``: those that other rows hold, too.

    The keys are in global order; those left out come before them.  NULL: too few
    are left for any link, or an equal set of the same block has them.  The digest
    of an empty set is NULL.
    """
    size = text_bytes(docs)
    bits = min(64, max(size, 1).bit_length() + 3)
    shift = min(63, max(0, bits - (size // PART_BYTES).bit_length()))
    hashed = hashed_blocks(docs, bits, shift)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        data = unpack(block["data"][0])
        sizes = unpack_numbers(block["counts"][0]).astype(np.int64)
        ends = np.cumsum(sizes).tolist()
        sets = [shingles(data[e - s : e]) for s, e in zip(sizes.tolist(), ends, strict=True)]
        hashes, _ = held_hashes(sets, bits)
        level = [np.frombuffer(unpack(x), np.uint8) for x in told.sort_by("part")["levels"]]
        level = np.concatenate([*level, np.empty(0, np.uint8)])
        seen: set[bytes] = set()
        out: dict[str, list] = {"n": [], "digest": [], "keys": []}
        for s in sets:
            digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
            keys = None
            if digest and digest not in seen:
                seen.add(digest)
                own = level[np.searchsorted(hashes, s >> np.uint64(64 - bits))].astype(np.uint64)
                several = own > 1
                if several.sum() >= overlap_of(len(s)):
                    ordered = (own << np.uint64(HASH_BITS)) | (s >> np.uint64(64 - HASH_BITS))
                    keys = np.sort(ordered[several]).tobytes()
            for c, v in zip(out, (len(s), digest, keys), strict=True):
                out[c].append(v)
        return pa.table(
            {
                "doc_id": block["ids"].combine_chunks().flatten(),
                "n": pa.array(out["n"], pa.int64()),
                "digest": pa.array(out["digest"], pa.binary()),
                "keys": pa.array(out["keys"], pa.binary()),
            }
        )

    texts = hashed.where(F.col("part") == TEXTS).select("block", "data", "ids", "counts")
    rows = texts.groupBy("block").cogroup(levels(hashed).groupBy("block"))
    return saved(rows.applyInArrow(run, f"doc_id {id_type}, n bigint, digest binary, keys binary"), "ordered-sets")


# -- buckets ---------------------------------------------------------------------


def prefixes(sets: DataFrame) -> DataFrame:
    """(key, digest, n, place): the prefix of each set; ``place`` is the key's in the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b["n"].to_numpy()
            keys = [np.frombuffer(k, np.int64) for k in b["keys"].to_pylist()]
            before = [int(size) - len(k) for size, k in zip(n, keys, strict=True)]
            took = [max(0, int(size) - overlap_of(int(size)) + 1 - s) for size, s in zip(n, before, strict=True)]
            own = [k[:t] for k, t in zip(keys, took, strict=True)]
            place = [np.arange(s, s + len(k)) for s, k in zip(before, own, strict=True)]
            at = np.repeat(np.arange(len(n)), [len(k) for k in own])
            empty = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([empty, *own])),
                    b["digest"].take(pa.array(at)),
                    pa.array(n[at]),
                    pa.array(np.concatenate([empty, *place])),
                ],
                ["key", "digest", "n", "place"],
            )

    return sets.mapInArrow(run, "key bigint, digest binary, n bigint, place bigint")


def buckets(sets: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` in buckets of two sets or more, of equal buckets the first key's.

    The first key that two sets share stays where its bucket is one of several
    with the same members, so that a test of what follows it holds.
    """
    rows = saved(prefixes(sets), "prefixes")
    h = [F.bit_xor(F.xxhash64("digest", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
    same = rows.groupBy("key").agg(F.count("*").alias("size"), *h).where("size > 1")
    first = same.groupBy("size", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    return saved(rows.join(first, "key"), "buckets")


def may_link(n1: Column, place1: Column, n2: Column, place2: Column) -> Column:
    """Whether sets whose first common key has these places can reach the threshold."""
    both = F.least(n1 - place1, n2 - place2)
    return (100 * F.least(n1, n2) >= THRESHOLD * F.greatest(n1, n2)) & (
        (100 + THRESHOLD) * both >= THRESHOLD * (n1 + n2)
    )


def candidates(rows: DataFrame) -> DataFrame:
    """(hub, x, n1, n2): pairs of a hub and another member of its bucket, in other components; each once."""
    hubs = rows.where("is_hub").select(
        "key", F.col("digest").alias("hub"), F.col("n").alias("n1"), F.col("place").alias("place1"), F.col("root").alias("root1")
    )
    others = rows.select(
        "key", F.col("digest").alias("x"), F.col("n").alias("n2"), "place", "root", F.col("is_hub").alias("both")
    )
    pairs = others.join(hubs, "key").where(F.col("root") != F.col("root1"))
    pairs = pairs.where(may_link(F.col("n1"), F.col("place1"), F.col("n2"), F.col("place")))
    pairs = pairs.where(~F.col("both") | (F.col("hub") < F.col("x")))
    # A pair may come from several buckets, and either way around.
    least, greatest = F.least("hub", "x").alias("a"), F.greatest("hub", "x").alias("b")
    return pairs.groupBy(least, greatest).agg(F.min(F.struct("hub", "x", "n1", "n2")).alias("p")).select("a", "b", "p.*")


# -- overlaps --------------------------------------------------------------------


def cuts(sets: DataFrame) -> np.ndarray:
    """Keys that cut the global order into FRAGMENTS of about equally many occurrences.

    Counted in cells, CELLS a level: at most 64 * CELLS rows reach the driver.
    """
    low = HASH_BITS - CELLS.bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.concatenate([np.empty(0, np.int64), *[np.frombuffer(k, np.int64) for k in b["keys"].to_pylist()]])
            cells, n = np.unique(keys >> low, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n.astype(np.int64))], ["cell", "n"])

    rows = sets.select("keys").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect()
    cells = sorted(map(tuple, rows))
    share = np.cumsum([n for _, n in cells]) if cells else np.zeros(1)
    at = np.searchsorted(share, share[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS)
    return np.array([cells[i][0] + 1 for i in at.tolist()] if cells else [0] * (FRAGMENTS - 1), np.int64) << low


def segments(sets: DataFrame) -> DataFrame:
    """(digest, fragment, segment): each set's keys in each fragment in which it has some."""
    at = cuts(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list] = [], [], []
            for digest, blob in zip(b["digest"].to_pylist(), b["keys"].to_pylist(), strict=True):
                keys = np.frombuffer(blob, np.int64)
                for fragment, segment in enumerate(np.split(keys, np.searchsorted(keys, at))):
                    if len(segment):
                        for column, value in zip(out, (digest, fragment, segment.tobytes()), strict=True):
                            column.append(value)
            types = (pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["digest", "fragment", "segment"]
            )

    return saved(sets.select("digest", "keys").mapInArrow(run, "digest binary, fragment int, segment binary"), "segments")


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(hub, x, both): how many keys the sets of each pair share, if any.

    A hub's segment meets those of its partners in tasks of bounded size; each
    partner's is sent once per hub.
    """
    per_hub = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("tasks"))
    task = F.pmod(F.xxhash64("x"), F.col("tasks")).cast("int").alias("task")
    sent = pairs.select("hub", "x").join(per_hub, "hub").select("hub", "x", task)
    sent = sent.join(parts.withColumnRenamed("digest", "x"), "x")
    own = per_hub.join(parts.withColumnRenamed("digest", "hub"), "hub")
    own = own.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    place = ["hub", "fragment", "task"]
    rows = sent.select(*place, "x", "segment").unionByName(
        own.select(*place, F.lit(None).cast("binary").alias("x"), "segment")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, np.empty(0, np.int64)
        for b in batches:
            found: tuple[list, list, list] = [], [], []
            places = zip(*(b[c].to_pylist() for c in place), strict=True)
            for here, x, blob in zip(places, b["x"].to_pylist(), b["segment"].to_pylist(), strict=True):
                keys = np.frombuffer(blob, np.int64)
                if x is None:
                    at, hub = here, keys
                elif here == at:
                    n = int((hub[np.minimum(np.searchsorted(hub, keys), len(hub) - 1)] == keys).sum())
                    if n:
                        for column, value in zip(found, (here[0], x, n), strict=True):
                            column.append(value)
            types = (pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types, strict=True)], ["hub", "x", "n"])

    # NULL sorts first: a hub's segment comes before those of its partners.
    sorted_rows = rows.repartition(*place).sortWithinPartitions(*place, "x")
    counted = sorted_rows.mapInArrow(run, "hub binary, x binary, n bigint")
    return counted.groupBy("hub", "x").agg(F.sum("n").alias("both"))


# -- the join --------------------------------------------------------------------


def links(sets: DataFrame) -> DataFrame:
    """(u, v): links between digests of ``sets`` that join all that is linked.

    The first hub of a bucket is the member that most buckets hold: of edited copies
    that is the one edited least, to which most others are linked.
    """
    rows = buckets(sets)
    central = rows.groupBy("digest").agg(F.count("*").alias("met"))
    rows = rows.join(central, "digest").withColumn("root", F.col("digest"))
    found = tested = None
    parts, hubs = segments(sets), HUBS
    while not rows.isEmpty():
        first = F.max(F.struct("met", F.xxhash64("digest"), "digest"))["digest"].alias("first")
        rows = rows.join(rows.groupBy("key").agg(F.count("*").alias("size"), first), "key")
        every = F.greatest(F.lit(1), F.floor(F.col("size") / hubs)).cast("long")
        chosen = F.pmod(F.xxhash64(F.lit(hubs), "digest"), every) == 0 if hubs > 1 else F.lit(False)
        rows = rows.withColumn("is_hub", chosen | (F.col("digest") == F.col("first"))).drop("size", "first")
        rows = saved(rows, "round")
        pairs = candidates(rows)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = saved(pairs, "candidates")
        reached = overlaps(pairs, parts).join(pairs, ["hub", "x"])
        linked = 100 * F.col("both") >= THRESHOLD * (F.col("n1") + F.col("n2") - F.col("both"))
        new = saved(reached.where(linked).select(F.col("hub").alias("u"), F.col("x").alias("v")), "links")
        found = new if found is None else found.unionByName(new)
        done = pairs.select("a", "b")
        tested = done if tested is None else tested.unionByName(done)
        rows = rows.where("NOT is_hub").drop("root", "is_hub")
        rows = rows.join(components(found).withColumnRenamed("node", "digest"), "digest", "left")
        rows = rows.withColumn("root", F.coalesce("root", "digest"))
        mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        rows = saved(rows.join(mixed.where("low != high").select("key"), "key"), "unresolved")
        hubs *= MORE
    if found is None:
        return sets.select(F.col("digest").alias("u"), F.col("digest").alias("v")).limit(0)
    return found


def linked_documents(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_shingles and component_id.

    Rows of equal sets are one node.  A NULL or empty text, or one without words,
    has an empty set and is its own component.  component_id is the least non-NULL
    doc_id of the component; of an empty set, the row's own.
    """
    rows = ordered_sets(docs.select("doc_id", "text"))
    sets = rows.where("keys IS NOT NULL").groupBy("digest").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    roots = components(links(saved(sets, "distinct-sets")))
    ids = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("low"))
    ids = ids.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    ids = ids.withColumn("root", F.coalesce("root", "digest"))
    least = ids.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = saved(ids.select("digest", "root").join(least, "root").select("digest", "component_id"), "classes")
    out = rows.select("doc_id", "n", "digest").join(ids, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
