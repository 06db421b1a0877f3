"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A bounded sample of labelled rows is turned to vectors: counts of byte trigrams,
weighted by their rarity among all documents, beside counts of the text's shape,
reduced by a singular value decomposition.  The labelled vectors go to all tasks;
each document's cosines to all of them are computed exactly, in blocks, and the
labels of its nearest vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import raw, remainder, text_function

#: Labelled rows at most that the model is fitted on; they go to all tasks, with
#: RANK 4-byte numbers each (1 MB in all).
MAX_LABELLED = 4000
#: Buckets of hashed trigrams.
TRIGRAMS = 2048
#: Byte classes: control and blank, digit, upper, lower, sentence mark, other
#: mark, part of a longer code point; counted in adjacent pairs.
CLASSES = 7
#: Words by the distance back to their last occurrence (powers of two; none), and
#: by their length.
GAPS, LENGTHS = 10, 12
SHAPE = CLASSES * CLASSES + GAPS + LENGTHS
DIMS = TRIGRAMS + SHAPE
RANK = 64
NEIGHBOURS = 15
#: Weight of a vote: cosine to this power.
SHARPNESS = 30
#: Length of the part of a vector that counts shape, against that of trigrams.
SHAPE_WEIGHT = 2
BLOCK = 512

CLASS = np.full(256, 5, np.uint8)
CLASS[:33] = 0
CLASS[48:58] = 1
CLASS[65:91] = 2
CLASS[97:123] = 3
CLASS[list(b".,;:!?'\"()-")] = 4
CLASS[128:] = 6


def counts(text: bytes) -> np.ndarray:
    """How often each term occurs in the text."""
    b = np.frombuffer(text, np.uint8)
    out = np.zeros(DIMS, np.float32)
    if len(b) >= 3:
        code = b[:-2].astype(np.uint32) << 16
        code |= b[1:-1].astype(np.uint32) << 8
        code |= b[2:]
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(21)
        out[:TRIGRAMS] = np.bincount(code, minlength=TRIGRAMS)
    if len(b) >= 2:
        kind = CLASS[b]
        pair = kind[:-1] * CLASSES + kind[1:]
        out[TRIGRAMS : TRIGRAMS + CLASSES * CLASSES] = np.bincount(pair, minlength=CLASSES * CLASSES)
    words = text.split()
    if words:
        last: dict[bytes, int] = {}
        gaps = np.zeros(GAPS, np.float32)
        for i, w in enumerate(words):
            before = last.get(w)
            gaps[GAPS - 1 if before is None else min(i - before, 255).bit_length()] += 1
            last[w] = i
        at = TRIGRAMS + CLASSES * CLASSES
        out[at : at + GAPS] = gaps
        sizes = np.minimum([len(w) for w in words], LENGTHS) - 1
        out[at + GAPS :] = np.bincount(sizes, minlength=LENGTHS)
    return out


def weigh(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts; trigrams and shape are two parts of fixed lengths."""
    rows = np.log1p(rows)
    rows[:, :TRIGRAMS] *= idf
    for part, size in ((rows[:, :TRIGRAMS], 1), (rows[:, TRIGRAMS:], SHAPE_WEIGHT)):
        part *= size / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def latent_axes(rows: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors, by randomised subspace iteration."""
    rank = min(rank, *rows.shape)
    start = np.random.default_rng(seed).standard_normal((rows.shape[1], rank + 16))
    basis = np.linalg.qr(rows @ start.astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(rows @ np.linalg.qr(rows.T @ basis)[0])[0]
    return np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:rank].T.astype(np.float32)


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each trigram bucket occurs, and their number; over all documents."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(TRIGRAMS, np.int64), 0
        for batch in rows:
            for text in batch.column(0):
                held += counts(text.as_py())[:TRIGRAMS] > 0
                n += 1
        term = np.arange(-1, TRIGRAMS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.r_[n, held])], ["term", "n"])

    parts = docs.select(raw(F.col("text")).alias("text")).mapInArrow(task, "term int, n bigint")
    sums = dict(parts.groupBy("term").agg(F.sum("n")).collect())
    return np.array([sums.get(t, 0) for t in range(TRIGRAMS)]), sums.get(-1, 0)


class Model:
    """Axes, and vectors with their labels.  ``prior`` is the score of a text without a vector."""

    def __init__(self, idf: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.idf, self.labels = idf.astype(np.float32), labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if len(labels):
            weighed = weigh(rows, self.idf)
            self.axes = latent_axes(weighed, RANK)
            self.vectors = unit(weighed @ self.axes)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for start in range(0, len(texts), BLOCK):
            block = texts[start : start + BLOCK]
            rows = weigh(np.stack([counts(t) for t in block]), self.idf)
            near = unit(rows @ self.axes) @ self.vectors.T
            # The k nearest, and whoever is as near as the last of them.
            least = np.partition(near, -k, axis=1)[:, -k, None]
            weight = np.where(near >= least, np.maximum(near, 0) ** SHARPNESS, 0)
            total = weight.sum(1)
            some = (total > 0) & (rows.any(1))
            at = np.flatnonzero(some)
            out[start + at] = (weight[at] @ self.labels) / total[at]
        return np.clip(out, 0, 1)


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from at most MAX_LABELLED labelled rows, the least by hash of their ids.

    Rows held out and labels other than 0 and 1 are left out; an id labelled
    twice counts with the mean.  Of rows that share an id, one is used.
    """
    seen, n = document_counts(docs)
    idf = np.log((n + 1) / (seen + 1)) + 0.1
    usable = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    # Only ids of this table's documents: a filtered table has fewer.
    present = docs.select("doc_id").join(usable.select("doc_id"), "doc_id", "left_semi")
    each = usable.join(present, "doc_id", "left_semi").groupBy("doc_id").agg(F.avg(label).alias("label"))
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    run = text_function("counts binary", lambda texts: {"counts": [counts(t).tobytes() for t in texts]})
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", "label", run(F.col("text")).alias("out")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    table = np.frombuffer(b"".join(r["out"]["counts"] for r in rows), np.float32).reshape(len(rows), DIMS)
    return Model(idf, table, np.array([r["label"] for r in rows], np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` as ``doc``, with its ``score``.

    A NULL or empty text scores the share of good labels in the sample (0.5 with
    no labels at all).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = text_function("score double", lambda texts: {"score": shared.value.scores(texts)})
    return docs.select(F.struct("*").alias("doc"), run(F.col("text")).alias("out")).select(
        "doc", "out.score"
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row doc_id, held_out, score and predicted."""
    docs = docs.select("doc_id", "text")
    rows = score(docs, fit(docs, labels.select("doc_id", "quality")))
    return rows.select(
        "doc.doc_id",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
