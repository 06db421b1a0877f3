"""Alignment of two tokenizers' cuts, once per distinct text.

Texts are shuffled by their whole content, so that each is tokenised once; what
it adds to corpus-wide counts is weighted by how many rows hold it, and its
measures are joined to the rows again by the digest of the text.

Two tokens are linked if their byte ranges overlap.  Places where tokens of both
sides end cut a text into groups.  A link's count is the number of rows whose text
links the same two ids; a link is best if no other partner of its A id has more.

Blocks of texts name the distinct pairs they hold, with their weights; the pairs
are summed, and a block is told the totals of its own pairs only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.blocks import blocks, pack_numbers, unpack_numbers, with_answers
from velotide.llm.bpe import PIECES, byte_alphabet
from velotide.llm.common import saved

#: Bytes of text that are tokenised at a time.
CHUNK = 1 << 20
#: Fixed value: the character that stands for a space in a piece.
SPACE = "▁"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Aligner:
    """Both tokenizers: A byte-level BPE from a JSON file, B from a sentencepiece model."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path_a}: ids do not follow the order of merges")
        self.a = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.a_bytes[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths = [np.array([len(t) for t in side]) for side in (self.a_bytes, self.b_bytes)]
        most = max(len(self.a_bytes), len(self.b_bytes))
        width = len(str(most))
        decimal = np.array([str(i).encode() for i in range(most)], f"S{width + 1}")
        # Each id in decimal, with room for one more character.
        self.digits = decimal.view(np.uint8).reshape(most, width + 1)
        self.n_digits = (self.digits != 0).sum(1)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """The ids of both sides; none where a side's bytes are not those of the text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a = self.a.encode_ordinary(" " + text)
            whole = (" " + text).encode()
            same = text and all(
                b"".join([table[i] for i in ids]) == whole
                for table, ids in ((self.a_bytes, a), (self.b_bytes, b))
            )
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str]) -> Alignment:
        return Alignment(self, self.tokens(texts))


class Alignment:
    """Texts beside one another, as arrays over all their tokens."""

    def __init__(self, aligner: Aligner, tokens: list[tuple[list[int], list[int]]]):
        self.aligner = aligner
        self.ids, ends, self.n = [], [], []
        for side in (0, 1):
            ids = np.fromiter(chain.from_iterable(t[side] for t in tokens), np.int64)
            self.ids.append(ids)
            ends.append(np.cumsum(aligner.lengths[side][ids]))
            self.n.append(np.array([len(t[side]) for t in tokens], np.int64))
        a, b = ends
        # Texts without tokens have no bytes here, so both sides agree on where a text ends.
        stops = np.r_[0, a][np.cumsum(self.n[0])]
        self.last = [np.isin(a, b, assume_unique=True), np.isin(b, a, assume_unique=True)]
        self.ends, cuts = ends, a[self.last[0]]
        self.group = [np.searchsorted(cuts, e) for e in ends]
        self.n_groups = self._per_text(cuts, stops)
        every = np.union1d(a, b)
        self.n_links = self._per_text(every, stops)
        self.links = (
            self.ids[0][np.searchsorted(a, every)] * len(aligner.b_bytes) + self.ids[1][np.searchsorted(b, every)]
        )

    @staticmethod
    def _per_text(places: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, stops, "right"), prepend=0)

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text: the ids of both sides, group by group."""
        digits, n_digits = self.aligner.digits, self.aligner.n_digits
        order = np.argsort(np.r_[2 * self.group[0], 2 * self.group[1] + 1], kind="stable")
        marks = [np.where(last, ord(m), ord(",")) for last, m in zip(self.last, "|;", strict=True)]
        with_tokens = self.n[1] > 0
        marks[1][np.cumsum(self.n[1])[with_tokens] - 1] = 0  # nothing after the last token of a text
        ids, mark = np.concatenate(self.ids)[order], np.concatenate(marks)[order]
        chars = digits[ids]
        chars[np.arange(len(ids)), n_digits[ids]] = mark
        sizes = np.r_[0, np.cumsum((chars != 0).sum(1))]
        flat = chars[chars != 0].tobytes()
        at = sizes[np.r_[0, np.cumsum(self.n[0] + self.n[1])]].tolist()
        return [flat[i:j] for i, j in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker."""
    return Aligner(path_a, path_b)


def chunks(texts: list[str]) -> Iterator[list[str]]:
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= CHUNK:
            yield held
            held, n = [], 0
    if held:
        yield held


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, digest, n): each text that isn't empty, with its number of rows."""
    texts = docs.where("text != ''").groupBy("text").agg(F.count("*").alias("n"))
    return texts.select("text", digest(), "n")


def digest():
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(text, n, a_ids, b_ids, groups) for each distinct text that isn't empty.

    ``groups`` lists the ids of each group, as in ``Alignment.groups``.  A text
    whose tokens don't spell it again has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            texts = batch["text"].to_pylist()
            tokens = own.tokens(texts)
            groups = Alignment(own, tokens).groups()
            columns = [texts, batch["n"], [t[0] for t in tokens], [t[1] for t in tokens], [g.decode() for g in groups]]
            types = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
            arrays = [pa.array(c, t) if isinstance(c, list) else c for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["text", "n", "a_ids", "b_ids", "groups"])

    schema = "text string, n bigint, a_ids array<int>, b_ids array<int>, groups string"
    return distinct_texts(docs).select("text", "n").mapInArrow(run, schema)


BLOCK = (
    "block bigint, digest array<binary>, n array<bigint>, n_a array<bigint>, n_b array<bigint>, "
    "n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "pairs binary, weights binary, links binary"
)


def block_row(own: Aligner, number: int, rows: pa.Table) -> dict:
    """A block's measures, its distinct pairs with their weights, and its links as places among them."""
    n = rows["n"].to_numpy()
    out = {"block": number, "digest": rows["digest"].to_pylist(), "n": n}
    figures: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links")}
    sums, links = [], []
    for texts in chunks(rows["text"].to_pylist()):
        found = own.align(texts)
        for name, values in zip(figures, (*found.n, found.n_groups, found.n_links), strict=True):
            figures[name].append(values)
        sums += [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups()]
        links.append(found.links)
    out |= {k: np.concatenate(v) for k, v in figures.items()} | {"groups_sha256": sums}
    pairs, at, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    # The most frequent pair comes first, so that places are small numbers.
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(pairs), np.int64)
    place[order] = np.arange(len(pairs))
    pairs, at = pairs[order], place[at]
    held = np.unique(np.repeat(np.arange(len(n)), out["n_links"]) * max(len(pairs), 1) + at)
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, held % max(len(pairs), 1), n[held // max(len(pairs), 1)])
    return out | {"pairs": pack_numbers(pairs), "weights": pack_numbers(weights), "links": pack_numbers(at)}


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for number, rows in blocks(batches):
            row = block_row(own, number, rows)
            yield pa.RecordBatch.from_pylist([row], pa.schema(FIELDS))

    return saved(distinct_texts(docs).mapInArrow(run, BLOCK), "aligned-blocks")


FIELDS = [
    ("block", pa.int64()),
    ("digest", pa.list_(pa.binary())),
    *[(c, pa.list_(pa.int64())) for c in ("n", "n_a", "n_b", "n_groups", "n_links")],
    ("groups_sha256", pa.list_(pa.string())),
    *[(c, pa.binary()) for c in ("pairs", "weights", "links")],
]


def block_pairs(aligned: DataFrame) -> DataFrame:
    """(block, pair, n): the distinct pairs of each block and their rows in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, weights in zip(*(batch[c].to_pylist() for c in ("block", "pairs", "weights")), strict=True):
                keys = unpack_numbers(pairs).astype(np.int64)
                columns = [np.full(len(keys), block), keys, unpack_numbers(weights).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "pair", "n"])

    return aligned.select("block", "pairs", "weights").mapInArrow(run, "block bigint, pair bigint, n bigint")


def pair_counts(pairs: DataFrame, ids_b: int) -> DataFrame:
    """(pair, total, best): rows that hold each pair, and whether its A id has no more frequent one.

    ``pair`` is A's id times ``ids_b`` plus B's id.
    """
    total = saved(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    total = total.withColumn("a", F.expr(f"pair div {ids_b}L"))
    most = total.groupBy("a").agg(F.max("total").alias("most"))
    return total.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def measures(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(digest, n, the MEASURES, groups_sha256) of each distinct text that isn't empty."""
    aligned = aligned_blocks(docs, path_a, path_b)
    pairs = saved(block_pairs(aligned), "block-pairs")
    ids_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    told = pairs.select("block", "pair").join(pair_counts(pairs, ids_b), "pair")

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        pairs = unpack_numbers(row["pairs"]).astype(np.int64)
        links = unpack_numbers(row["links"]).astype(np.int64)
        keys = answers["pair"].to_numpy()
        order = np.argsort(keys)
        at = order[np.searchsorted(keys, pairs, sorter=order)]
        total, best = answers["total"].to_numpy()[at], answers["best"].to_numpy()[at]
        stops = np.cumsum(row["n_links"])

        def per_text(values: np.ndarray) -> np.ndarray:
            sums = np.r_[0, np.cumsum(values, dtype=np.int64)]
            return np.diff(sums[stops], prepend=0)

        columns = {c: row[c] for c in ("digest", "n", "n_a", "n_b", "n_groups", "n_links")}
        columns |= {"n_best": per_text(best[links]), "count_sum": per_text(total[links])}
        return pa.table(columns | {"groups_sha256": row["groups_sha256"]}, schema=pa.schema(OUT))

    # A block whose texts all lack tokens is told nothing, and has its zeros.
    schema = "digest binary, n bigint, " + ", ".join(f"{c} bigint" for c in MEASURES) + ", groups_sha256 string"
    return aligned.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


OUT = [("digest", pa.binary()), *[(c, pa.int64()) for c in ("n", *MEASURES)], ("groups_sha256", pa.string())]


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row doc_id, the MEASURES and groups_sha256.

    NULL and empty texts, and texts that either side's tokens don't spell again,
    have zeros and ''.  Repeated rows count each in the pairs' counts and have a
    result each.
    """
    docs = docs.select("doc_id", "text")
    found = saved(measures(docs, path_a, path_b), "text-measures")
    rows = with_answers(docs.select("doc_id", digest()), found, "digest", "n")
    return rows.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
