"""Language-model scores by context-tree weighting over bytes.

Each byte is coded as eight binary decisions, first bit first, each in the
context of the bytes before it and of the bits already coded.  For every context
of 0 to DEPTH bytes a Krichevsky-Trofimov estimator counts the decisions seen
there in training.  The weighted probability of a context mixes, half and half,
its own estimate with the product of those of the contexts one byte longer;
what a decision is then predicted as is a mixture of the estimates of all
depths, weighed by how well each has coded the training texts.  A text ends with
the byte 0xFF, which UTF-8 never holds, and starts after DEPTH such bytes, so
the probabilities of all texts add up to one.

With the counts fixed, a text's probability is a product over its grams, a gram
being DEPTH bytes of context and the byte coded.  The work is shared out thus:

* Texts are dealt into blocks of bounded size; a block counts its distinct grams
  and words, once for all its texts.
* Counts are added up by gram.  Grams that share their two last context bytes
  are one subtree, and worked on together; a subtree holds at most
  256 ** (DEPTH - 1) grams.  The two levels above it have at most 256 * 255
  nodes, whatever the corpus.
* The probabilities go back to the blocks that asked for them.

So what is shuffled grows with the number of blocks, and no model is gathered in
one place.  Grams of texts that aren't trained on are in the tree with count 0,
which changes nothing for the others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import pack, partitions_for, raw, remainder, saved, text_bytes, unpack

DEPTH = 5
#: Bytes of text in a block, and those counted at a time.
BLOCK_BYTES, CHUNK = 24 << 20, 1 << 19
#: Rows that go back to Spark at a time: it holds a batch in memory of its own.
ROWS = 20_000
#: Grams that one task works on (of several subtrees, or of a large one).
GRAMS_PER_TASK = 500_000
END = 0xFF
LOG10 = math.log(10)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of texts, one per byte and end, and how many each text has.

    A gram's top byte is the one right before the byte coded, which is at the
    bottom: sorted grams stand by context, the nearest byte first.
    """
    pad = bytes([END]) * DEPTH
    b = np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)
    # A text and its DEPTH end bytes: only the first of those is coded.
    n = len(b) - DEPTH
    out = np.zeros(n, np.int64)
    for k in range(1, DEPTH + 1):
        out = (out << 8) | b[DEPTH - k : DEPTH - k + n]
    out = (out << 8) | b[DEPTH:]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    keep = np.ones(n, bool)
    ends = np.cumsum(sizes + DEPTH - 1)
    for k in range(1, DEPTH):
        keep[ends - k] = False
    return out[keep], sizes


def distinct(texts: list[bytes], trained: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct grams, sorted, and how often each occurs in texts trained on."""
    found, sizes = grams(texts)
    # The lowest bit says whether the gram is from such a text, so one sort of
    # plain numbers both finds the distinct ones and counts them.
    found = (found << 1) | np.repeat(np.array(trained, np.int64), sizes)
    found.sort()
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]][: len(found)])
    counts = np.diff(np.r_[first, len(found)])
    keys = found[first]
    return added(keys >> 1, np.where(keys & 1, counts, 0), in_order=True)


def added(keys: np.ndarray, counts: np.ndarray, in_order: bool = False):
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    if not in_order:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


_TABLE = np.array([math.lgamma(i / 2) if i else 0.0 for i in range(4096)])


def lgamma_half(twice: np.ndarray) -> np.ndarray:
    """log Gamma(twice / 2): from a table, or by Stirling's series."""
    small = _TABLE[np.minimum(twice, len(_TABLE) - 1)]
    if not len(twice) or twice.max() < len(_TABLE):
        return small
    x = twice / 2
    large = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(twice < len(_TABLE), small, large)


def estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    both = lgamma_half(2 * n0 + 1) + lgamma_half(2 * n1 + 1) - lgamma_half(2 * (n0 + n1) + 2)
    return both - math.log(math.pi)


class Level:
    """The nodes of one depth: for each number of bits already coded, sorted keys
    (context, those bits) with the counts of zeros and ones, the log of the
    estimate and of the weighted probability."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys``: sorted distinct (context, byte)."""
        self.grams, self.nodes = keys, []
        for bits in range(8):
            of = keys >> (8 - bits)
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]][: len(of)])
            one = (keys >> (7 - bits)) & 1
            total = np.add.reduceat(counts, first) if len(first) else counts[:0]
            ones = np.add.reduceat(counts * one, first) if len(first) else counts[:0]
            self.nodes.append(Nodes(of[first], total - ones, ones))


class Nodes:
    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray):
        self.keys, self.n0, self.n1 = keys, n0, n1
        self.own = estimate(n0, n1)
        self.weighted = self.own  # as for a leaf

    def join(self, below: np.ndarray) -> None:
        """Mix with the contexts one byte longer; ``below``: the log of their product."""
        self.weighted = math.log(0.5) + np.logaddexp(self.own, below)

    def predict(self, above: np.ndarray, left: np.ndarray, leaf: bool) -> None:
        """Sum up the mixture for a one: ``above`` so far, and the weight ``left`` over."""
        share = 1.0 if leaf else np.exp(math.log(0.5) + self.own - self.weighted)
        self.above = above + left * share * (self.n1 + 0.5) / (self.n0 + self.n1 + 1)
        self.left = left * (1 - share)


def parent(keys: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Keys of the nodes with a context one byte shorter."""
    return ((keys >> (bits + 8)) << bits) | (keys & ((1 << bits) - 1))


def forest(keys: np.ndarray, counts: np.ndarray, top: int) -> list[Level]:
    """Levels ``top`` to DEPTH over sorted distinct grams, weighted from the leaves up."""
    levels = [Level(keys, counts)]
    for depth in range(DEPTH - 1, top - 1, -1):
        below = levels[0]
        keys, counts = added(parent(keys, depth + 1, 8), counts)
        level = Level(keys, counts)
        for bits in range(8):
            node, child = level.nodes[bits], below.nodes[bits]
            at = np.searchsorted(node.keys, parent(child.keys, depth + 1, bits))
            node.join(np.bincount(at, weights=child.weighted, minlength=len(node.keys)))
        levels.insert(0, level)
    return levels


class Top:
    """Depths 0 and 1, from the sums over all subtrees; at most 256 * 255 nodes."""

    def __init__(self, rows: pd.DataFrame):
        """``rows``: bits, key (of depth 1), n0, n1, below (log product of depth 2)."""
        self.keys, self.above, self.left = [], [], []
        for bits in range(8):
            own = rows[rows["bits"] == bits].sort_values("key")
            one = Nodes(*(own[c].to_numpy(np.int64) for c in ("key", "n0", "n1")))
            one.join(own["below"].to_numpy(float))
            up = parent(one.keys, 1, bits)
            root_keys, at = np.unique(up, return_inverse=True)

            def summed(x, at=at, n=len(root_keys)):
                return np.bincount(at, weights=x, minlength=n)

            root = Nodes(root_keys, summed(one.n0).astype(np.int64), summed(one.n1).astype(np.int64))
            root.join(summed(one.weighted))
            root.predict(np.zeros(len(root_keys)), np.ones(len(root_keys)), leaf=False)
            one.predict(root.above[at], root.left[at], leaf=False)
            self.keys.append(one.keys)
            self.above.append(one.above)
            self.left.append(one.left)


def log10_probabilities(levels: list[Level], top: Top) -> np.ndarray:
    """For each gram of the deepest level, log10 of the byte's probability in its context."""
    leaves = levels[-1].grams
    total = np.zeros(len(leaves))
    for bits in range(8):
        keys, above, left = top.keys[bits], top.above[bits], top.left[bits]
        for depth, level in enumerate(levels, 2):
            node = level.nodes[bits]
            at = np.searchsorted(keys, parent(node.keys, depth, bits))
            node.predict(above[at], left[at], leaf=depth == DEPTH)
            keys, above, left = node.keys, node.above, node.left
        p = above[np.searchsorted(keys, leaves >> (8 - bits))]
        total += np.log(np.where((leaves >> (7 - bits)) & 1, p, 1 - p))
    return total / LOG10


class Lookup:
    """Values by key, in an open hash table: one array access for most keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(1.5 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits)
        slots, left = self.slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == -1
            self.keys[slots[left[free]]] = keys[left[free]]  # of those for one slot, the last stays
            placed = self.keys[slots[left]] == keys[left]
            self.values[slots[left[placed]]] = values[left[placed]]
            left = left[~placed]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all in the table."""
        slots = self.slots(keys)
        left = np.flatnonzero(self.keys[slots] != keys)
        while len(left):
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            left = left[self.keys[slots[left]] != keys[left]]
        return self.values[slots]


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 7) == 2


def chunks(texts: list[bytes]) -> Iterator[slice]:
    """Ranges of texts of about CHUNK bytes."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t) + DEPTH
        if n >= CHUNK:
            yield slice(start, i + 1)
            start, n = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


COUNTS = "block int, gram bigint, token binary, n bigint"


def count_block(rows: pa.Table) -> pa.Table:
    """A block's distinct grams and words, and how often its texts trained on hold them.

    A NULL word stands for the end of a text.
    """
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    words: Counter[bytes] = Counter()
    n_trained = 0
    for batch in rows.to_batches():
        texts = [unpack(b) for b in batch["blob"].to_pylist()]
        trained = [not h for h in batch["held_out"].to_pylist()]
        n_trained += sum(trained)
        for part in chunks(texts):
            k, c = distinct(texts[part], trained[part])
            keys, counts = added(np.r_[keys, k], np.r_[counts, c])
        for t, own in zip(texts, trained, strict=True):
            if own:
                words.update(t.split())
            else:
                for w in t.split():
                    words[w] += 0
    n, m = len(keys), len(words) + 1
    token = pa.array([*[None] * n, *words, b""], pa.binary())
    counted = pa.table(
        {
            "block": pa.array(np.full(n + m, rows["block"][0].as_py(), np.int32)),
            "gram": pa.array(np.r_[keys, np.full(m, -1)], pa.int64()),
            "token": token,
            "n": pa.array(np.r_[counts, list(words.values()), n_trained].astype(np.int64)),
        }
    )
    return pa.Table.from_batches(counted.to_batches(ROWS))


def subtrees(counted: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run`` (forest -> RecordBatch) to tasks that each hold whole subtrees."""
    spark = counted.sparkSession
    n = partitions_for(spark, counted.count(), GRAMS_PER_TASK)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if rows:
            keys, counts = added(*(np.concatenate(x) for x in zip(*rows, strict=True)))
            yield from pa.Table.from_batches([run(forest(keys, counts, 2))]).to_batches(ROWS)

    dealt = counted.select("gram", "n").repartition(n, F.expr(f"shiftright(gram, {8 * (DEPTH - 1)})"))
    return dealt.mapInArrow(task, schema)


def top_of(counted: DataFrame) -> Top:
    """Sum up the subtrees; the result has at most 256 * 255 rows."""

    def sums(levels: list[Level]) -> pa.RecordBatch:
        parts = []
        for bits, node in enumerate(levels[0].nodes):
            keys, at = np.unique(parent(node.keys, 2, bits), return_inverse=True)
            total = {c: np.bincount(at, weights=v, minlength=len(keys)) for c, v in
                     (("n0", node.n0), ("n1", node.n1), ("below", node.weighted))}
            parts.append(pd.DataFrame({"bits": bits, "key": keys} | total))
        out = pd.concat(parts).astype({"bits": "int32", "n0": "int64", "n1": "int64"})
        return pa.RecordBatch.from_pandas(out, preserve_index=False)

    rows = subtrees(counted, sums, "bits int, key bigint, n0 bigint, n1 bigint, below double")
    total = rows.groupBy("bits", "key").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below")))
    names = ["bits", "key", "n0", "n1", "below"]
    return Top(pd.DataFrame([tuple(r) for r in total.select(*names).collect()], columns=names))


def model(counted: DataFrame) -> DataFrame:
    """(gram, value): log10 of the probability of each gram's byte in its context."""
    shared = counted.sparkSession.sparkContext.broadcast(top_of(counted))

    def values(levels: list[Level]) -> pa.RecordBatch:
        found = log10_probabilities(levels, shared.value)
        return pa.RecordBatch.from_arrays([pa.array(levels[-1].grams), pa.array(found)], ["gram", "value"])

    return subtrees(counted, values, "gram bigint, value double")


SCORES = (
    "doc_id {id}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, n_bytes bigint"
)


def score(docs: DataFrame) -> DataFrame:
    """Per row doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    The model learns from rows that aren't held out.  ``score`` is its log10
    probability of the text with its end, in lower case; ``-score / n_bytes *
    log2(10)`` is the code length in bits per byte.  NULL counts as the empty
    text, which has its end alone.  Rows of equal id and text share a block; each
    has its result.  ``base_score`` is that of the words alone, with one added to
    each count.
    """
    spark = docs.sparkSession
    n_blocks = text_bytes(docs) // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block")

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack(t.lower()))

    rows = docs.select(
        "doc_id", packed(raw(F.col("text"))).alias("blob"), held_out(F.col("doc_id")).alias("held_out"), block
    )
    dealt = rows.repartition(n_blocks, "block").groupBy("block")
    counted = saved(dealt.applyInArrow(count_block, COUNTS), "lm-counts")

    in_grams = counted.where("token IS NULL").select("block", "gram", "n")
    in_words = counted.where("token IS NOT NULL").select("block", "token", "n")
    by_gram = saved(in_grams.groupBy("gram").agg(F.sum("n").alias("n")), "lm-grams")
    by_word = saved(in_words.groupBy("token").agg(F.sum("n").alias("n")), "lm-words")
    total, kinds = by_word.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    total = total or 0

    answers = in_grams.select("block", "gram").join(saved(model(by_gram), "lm-model"), "gram")
    answers = answers.select("block", "gram", F.lit(None).cast("binary").alias("token"), "value")
    words = in_words.select("block", "token").join(by_word, "token")
    words = words.select(
        "block", F.lit(-1).cast("long").alias("gram"), "token", F.col("n").cast("double").alias("value")
    )

    def score_block(texts: pa.Table, told: pa.Table) -> pa.Table:
        keys, values = told["gram"].to_numpy(), told["value"].to_numpy()
        ours = keys >= 0
        table = Lookup(keys[ours], values[ours])
        words, held = told["token"].filter(pa.array(~ours)).combine_chunks(), values[~ours]
        logs = np.log10(held + 1) - math.log10(total + kinds + 1)
        out = []
        for batch in texts.to_batches():
            own = [unpack(b) for b in batch["blob"].to_pylist()]
            scores = []
            for part in chunks(own):
                found, sizes = grams(own[part])
                scores.append(np.add.reduceat(table.get(found), np.cumsum(sizes) - sizes))
            tokens = [[*t.split(), b""] for t in own]
            sizes = np.array([len(x) for x in tokens], np.int64)
            starts = np.cumsum(sizes) - sizes
            # An index of the block's words, as numbers: no Python object for each.
            at = pc.index_in(pa.array(chain.from_iterable(tokens), pa.binary()), words).to_numpy()
            figures = {
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat(held[at] > 0, starts, dtype=np.int64)),
                "train_tokens": pa.array([total] * len(own), pa.int64()),
                "base_score": pa.array(np.add.reduceat(logs[at], starts)),
                "score": pa.array(np.concatenate(scores), pa.float64()),
                "n_bytes": pa.array([len(t) for t in own], pa.int64()),
            }
            columns = {"doc_id": batch["doc_id"], "held_out": batch["held_out"], **figures}
            out.append(pa.RecordBatch.from_pydict(columns))
        return pa.Table.from_batches(out)

    schema = SCORES.format(id=rows.schema["doc_id"].dataType.simpleString())
    told = answers.unionByName(words).repartition(n_blocks, "block").groupBy("block")
    return dealt.cogroup(told).applyInArrow(score_block, schema)
