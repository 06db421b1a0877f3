"""Byte-level BPE: speculate a tokenization, verify it, repair what fails.

A word is first cut greedily into longest vocabulary entries.  A sequence of
tokens is what byte-pair merging yields if and only if each token merges to
itself and each adjacent pair is compatible, that is, merging the bytes of both
together never joins across their border.  The check runs on all new pairs of a
batch at once; only words with a failing token or pair are merged step by step.

Texts: NULL and '' give no tokens.  A special token's string in a text becomes
its id, as the tokenizers library does by default.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import raw, text_function

#: Fixed value: the pre-tokenizer's pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words remembered by one Python worker; beyond this it starts afresh.
REMEMBERED = 250_000
#: Failing words of up to so many bytes are merged together, longer ones each with a queue.
SHORT = 64
#: Above any merge rank.
NEVER = np.iinfo(np.int32).max


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A vocabulary with its merges as arrays.

    ``rank``: the merge that makes a token (-1: a single byte); ``left`` and
    ``right``: its two parts; ``pairs``: sorted keys of the parts of each merge,
    with ``pair_rank`` beside it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.bytes = [b""] * self.size
        for t, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in t)
        for t, i in special.items():
            self.bytes[i] = t.encode()
        self.lengths = np.array([len(b) for b in self.bytes])
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.zeros(self.size, np.int64)
        self.right = np.zeros(self.size, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[a + b]
            self.merge[vocab[a], vocab[b]] = rank, made
            self.rank[made], self.left[made], self.right[made] = rank, vocab[a], vocab[b]
        keys = np.array([a * self.size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.pair_rank = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.made = np.array([i for _, i in self.merge.values()], np.int64)
        self.single = {self.bytes[i]: i for i in vocab.values() if len(self.bytes[i]) == 1}
        self.ids = {self.bytes[i]: i for i in vocab.values()}
        self.sound = self._sound()
        self.longest = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.longest.add_word(text.decode("latin-1"), i)
        self.longest.make_automaton()

    def joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NEVER without one."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, own: bool = False) -> np.ndarray:
        """Whether merging the bytes of a and b keeps them apart.

        Undo merges from the last to the first, at the right edge of a and the
        left edge of b.  ``x`` and ``y`` are the parts that meet at the border,
        and ``until_x`` and ``until_y`` the ranks at which each is taken up by a
        larger part.  They join across the border if their own merge comes
        before both; of equal ranks the leftmost pair is merged first.  ``own``
        leaves out the merge of a and b themselves.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x = np.full(len(a), NEVER, np.int64)
        until_y = np.full(len(a), NEVER, np.int64)
        first = True
        while len(live):
            joined = self.joins(x, y)
            if not (own and first):
                bad = (joined < until_x) & (joined <= until_y) & (joined < NEVER)
                good[live[bad]] = False
            else:
                bad = np.zeros(len(live), bool)
                until_x[:] = until_y[:] = joined
            first = False
            keep = ~bad & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            live, x, y = live[keep], x[keep], y[keep]
            until_x, until_y = until_x[keep], until_y[keep]
            undo_y = self.rank[y] >= self.rank[x]
            until_y = np.where(undo_y, self.rank[y], until_y)
            until_x = np.where(undo_y, until_x, self.rank[x])
            x, y = np.where(undo_y, x, self.right[x]), np.where(undo_y, self.left[y], y)
        return good

    def _sound(self) -> np.ndarray:
        """Tokens that their own bytes merge to."""
        sound = self.rank < 0
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        own = np.zeros(self.size, bool)
        own[made] = self.compatible(self.left[made], self.right[made], own=True)
        for i in made.tolist():
            sound[i] = own[i] and sound[self.left[i]] and sound[self.right[i]]
        return sound

    def guess(self, word: bytes) -> list[int]:
        """Longest vocabulary entries from left to right."""
        return [i for _, i in self.longest.iter_long(word.decode("latin-1"))]

    def exact(self, word: bytes) -> list[int]:
        """Merge step by step: always the lowest rank, of equal ones the leftmost."""
        part = [self.single[word[i : i + 1]] for i in range(len(word))]
        after = [*range(1, len(part)), -1]
        before = [*range(-1, len(part) - 1)]
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (m := self.merge.get((part[i], part[j]))):
                heapq.heappush(queue, (m[0], i, part[i], part[j], m[1]))

        for i in range(len(part)):
            offer(i)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue
            part[i], part[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p >= 0]


    def exact_many(self, words: list[bytes]) -> list[list[int]]:
        """``exact`` for many words: one merge in each word per round, all at once."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        table = np.array([self.single[bytes([b])] for b in range(256)], np.int64)
        part = table[np.frombuffer(b"".join(words), np.uint8)]
        of = np.repeat(np.arange(len(words)), sizes)
        while len(part):
            rank = np.full(len(part), NEVER, np.int64)
            same = np.flatnonzero(of[1:] == of[:-1])
            keys = part[same] * self.size + part[same + 1]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            hit = self.pairs[at] == keys
            rank[same[hit]] = self.pair_rank[at[hit]]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            ends = np.r_[starts[1:], len(part)]
            for k in np.flatnonzero(lowest == NEVER).tolist():
                out[of[starts[k]]] = part[starts[k] : ends[k]].tolist()
            low = np.repeat(lowest, ends - starts)
            chosen = np.flatnonzero((rank == low) & (low < NEVER))
            chosen = chosen[np.r_[True, of[chosen][1:] != of[chosen][:-1]]] if len(chosen) else chosen
            part[chosen] = self.made[rank[chosen]]
            keep = low < NEVER
            keep[chosen + 1] = False
            part, of = part[keep], of[keep]
        return out


class Encoder:
    """Encodes batches of texts; remembers words it has seen."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.words: dict[str, tuple[int, ...]] = {}
        self.ids = tuple(range(self.merges.size))  # one object for each id
        self.repaired = 0
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.pieces = regex.compile(PIECES)

    def learn(self, words: list[str]) -> None:
        """Speculate on new words, verify all their pairs at once, repair the rest."""
        m, known = self.merges, self.words
        raws = [w.encode("utf-8") for w in words]
        guesses = [[i] if (i := m.ids.get(r)) is not None else m.guess(r) for r in raws]
        sizes = np.array([len(g) for g in guesses])
        flat = np.fromiter((i for g in guesses for i in g), np.int64, sizes.sum())
        of = np.repeat(np.arange(len(words)), sizes)
        covered = np.bincount(of, weights=m.lengths[flat], minlength=len(words))
        good = covered == [len(r) for r in raws]
        good[of[~m.sound[flat]]] = False
        inside = np.flatnonzero(of[1:] == of[:-1])
        keys, back = np.unique(
            flat[inside] * m.size + flat[inside + 1], return_inverse=True
        )
        fits = m.compatible(keys // m.size, keys % m.size)
        good[of[inside[~fits[back]]]] = False
        failed = np.flatnonzero(~good).tolist()
        short = [i for i in failed if len(raws[i]) <= SHORT]
        for i, ids in zip(short, m.exact_many([raws[i] for i in short]), strict=True):
            guesses[i] = ids
        for i in failed:
            if len(raws[i]) > SHORT:
                guesses[i] = m.exact(raws[i])
        self.repaired += len(failed)
        shared = self.ids
        known.update((w, tuple([shared[i] for i in g])) for w, g in zip(words, guesses, strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        cut = []
        for text in texts:
            parts = self.special.split(text) if self.merges.special else [text]
            cut.append([self.pieces.findall(p) if k % 2 == 0 else p for k, p in enumerate(parts)])
        new = {w for parts in cut for p in parts[::2] for w in p}
        new.difference_update(self.words)
        if new:
            self.learn(list(new))
        out, words = [], self.words
        for parts in cut:
            ids: list[int] = []
            for k, p in enumerate(parts):
                if k % 2:
                    ids.append(self.merges.special[p])
                else:
                    for w in p:
                        ids += words[w]
            out.append(np.array(ids, np.int32))
        return out

    def decode(self, ids) -> str:
        table = self.merges.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def in_blocks(texts: list[bytes], size: int = 1 << 21) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` bytes."""
    block, n = [], 0
    for t in texts:
        block.append(t.decode("utf-8", "replace"))
        n += len(t)
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Every row of ``docs`` as ``doc``, with its ``ids`` (array of int).

    ``path`` names the vocabulary file, the same on every machine.
    """

    def ids(texts: list[bytes]) -> dict:
        own = encoder(path)
        return {"ids": [x for block in in_blocks(texts) for x in own.encode(block)]}

    run = text_function("ids array<int>", ids)
    return docs.select(F.struct("*").alias("doc"), run(F.col("text")).alias("out")).select(
        "doc", "out.ids"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with their ids turned back to ``decoded``."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield ids.map(encoder(path).decode)

    return encoded.withColumn("decoded", run.asNondeterministic()("ids"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass through Python."""

    def both(texts: list[bytes]) -> dict:
        own, ids, decoded = encoder(path), [], []
        for block in in_blocks(texts):
            new = own.encode(block)
            ids += new
            decoded += [own.decode(x.tolist()) for x in new]
        return {"ids": ids, "decoded": decoded}

    run = text_function("ids array<int>, decoded string", both)
    return docs.select(F.struct("*").alias("doc"), run(F.col("text")).alias("out")).select(
        "doc", "out.*"
    )


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    rows = round_trip(docs.select("doc_id", "text"), path)
    return rows.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(raw(F.col("decoded")), 256).alias("decoded_sha256"),
    )
