"""Benchmark passages in documents, found through an embedding of edit distance.

The CGK embedding walks over a sequence: at each step it writes the symbol it
stands on and, by a random bit drawn for that step and symbol, moves on or stays.
Sequences a few edits apart fall in step again after each edit, so that their
embeddings differ in few places: edit distance becomes Hamming distance.  Samples
of a few places each, over several walks, are the keys of hash tables; a window
of the size of an item that shares a key with it is verified exactly, by the edit
distance of the item to the nearest stretch of words around the window.

Symbols are words, lower-cased in A-Z, with punctuation counted as space.  An item is found
where at most TOLERANCE times its length words are inserted, deleted or replaced.
Windows that hold too few words of any item for that are left out before they are
embedded; this loses nothing.  Recall: tests/llm holds the method against edit
distance at every window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import mix, text_function

#: Edits per word of an item.
TOLERANCE = 0.2
#: Independent walks, samples of each, and places in a sample.
WALKS, SAMPLES, PLACES = 8, 16, 4
#: Steps per word of an item.  A walk makes one word in two steps; this many
#: steps seldom pass the item's end.
STEPS = 1.6
#: Items are searched for in blocks of about so many bytes of text, which go to all tasks.
BLOCK_BYTES = 8 << 20
#: Windows embedded at a time.
WINDOWS = 20_000

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_spaced = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
_places = np.random.default_rng(4242).random((WALKS, SAMPLES, PLACES))
_GOLD = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_spaced).split()


def allowed(length: int) -> int:
    """Edits for an item of so many words."""
    return int(TOLERANCE * length)


def window_keys(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash-table keys [window, walk * SAMPLES + sample] of windows of ``symbols``.

    Beyond a window's end there is symbol 0.  ``symbols`` must go on for the
    longest window after each start.
    """
    steps = np.maximum((STEPS * lengths).astype(np.int64), 1)
    written = np.empty((len(starts), steps.max(initial=1)), np.int64)
    rows = np.arange(len(starts))[:, None]
    keys = np.empty((len(starts), WALKS * SAMPLES), np.uint64)
    for walk in range(WALKS):
        at = np.zeros(len(starts), np.int64)
        for step in range(written.shape[1]):
            inside = at < lengths
            symbol = np.where(inside, symbols[starts + np.where(inside, at, 0)], 0)
            written[:, step] = symbol
            salt = np.uint64(((walk << 32 | step) * _GOLD) & (2**64 - 1))
            at += (mix(symbol.astype(np.uint64) + salt) >> np.uint64(63)).astype(np.int64)
        for sample in range(SAMPLES):
            places = (_places[walk, sample] * steps[:, None]).astype(np.int64)
            column = walk * SAMPLES + sample
            total = lengths.astype(np.uint64) + np.uint64(column << 32)
            for symbol in written[rows, places].T:
                total = mix(total * np.uint64(_GOLD) + symbol.astype(np.uint64))
            keys[:, column] = total
    return keys


def nearest(item: list[int], words: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``words``, and where that ends.

    Bit-parallel: an integer holds a column of the distance table as differences.
    """
    at: dict[int, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best = full, 0, size, (size, 0)
    for end, w in enumerate(words, 1):
        same = at.get(w, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        same |= down
        up, down = minus | (full & ~(same | plus)), plus & same
        if score < best[0]:
            best = (score, end)
    return best


class Items:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        known = self.vocabulary
        self.items = []
        for item_id, text in items:
            own = [known.setdefault(w, len(known) + 1) for w in words_of(text)]
            if own:
                self.items.append((item_id, own))
        lengths = np.array([len(x) for _, x in self.items], np.int64)
        self.longest = int(lengths.max(initial=0))
        self.fewest = min((len(x) - allowed(len(x)) for _, x in self.items), default=0)
        # By length of items: the words they hold, and the rarest k + 1 of each.  A
        # stretch within k edits of an item lacks at most k of its words.
        total = np.bincount([w for _, x in self.items for w in x], minlength=len(known) + 1)
        sizes = np.array([0, *map(len, known)])
        self.lengths, of = np.unique(lengths, return_inverse=True)
        self.held = np.zeros((len(self.lengths), len(known) + 1), bool)
        self.rare = np.zeros_like(self.held)
        for k, (_, own) in zip(of.tolist(), self.items, strict=True):
            self.held[k, own] = True
            rarest = sorted(own, key=lambda w: (total[w], -sizes[w], w))
            self.rare[k, rarest[: allowed(len(own)) + 1]] = True
        symbols = np.array([w for _, x in self.items for w in x] + [0], np.int64)
        starts = np.cumsum(lengths) - lengths
        keys = window_keys(symbols, starts, lengths) if self.items else np.empty((0, 1), np.uint64)
        flat = keys.ravel()
        order = np.argsort(flat, kind="stable")
        self.keys = flat[order]
        self.owner = np.repeat(np.arange(len(self.items)), keys.shape[1])[order]

    def symbols(self, text: bytes) -> np.ndarray:
        """Numbers of the words, 0 for those in no item."""
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def windows(self, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each length of items, the starts of windows with enough of their words.

        The first L words of a stretch within k edits of an item of L words share
        at least L - k with it, and one of its rarest k + 1.
        """
        inside = np.flatnonzero(symbols)
        if len(inside) < self.fewest:
            return
        own = symbols[inside]
        for k, length in enumerate(self.lengths.tolist()):
            rare = inside[self.rare[k][own]]
            if not len(rare):
                continue
            sums = np.zeros(len(symbols) + 1, np.int32)
            sums[1 + inside[self.held[k][own]]] = 1
            np.cumsum(sums, out=sums)
            need = length - allowed(length)
            if sums[-1] < need:
                continue
            # Starts of the windows that hold a rare word.
            starts = np.unique(np.maximum(rare[:, None] - np.arange(length), 0))
            ends = np.minimum(starts + length, len(symbols))
            starts = starts[sums[ends] - sums[starts] >= need]
            if len(starts):
                yield length, starts

    def candidates(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Distinct (window, item) that share a key."""
        found = []
        for k in range(0, len(starts), WINDOWS):
            part = slice(k, k + WINDOWS)
            keys = window_keys(symbols, starts[part], lengths[part])
            low = np.searchsorted(self.keys, keys.ravel(), "left")
            hit = np.flatnonzero(
                (low < len(self.keys)) & (self.keys[np.minimum(low, len(self.keys) - 1)] == keys.ravel())
            )
            high = np.searchsorted(self.keys, keys.ravel()[hit], "right")
            many = high - low[hit]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items = self.owner[np.repeat(low[hit], many) + within]
            window = np.repeat(hit // keys.shape[1], many) + k
            found.append(np.unique(window * len(self.items) + items))
        pairs = np.concatenate(found) if found else np.empty(0, np.int64)
        return zip((pairs // max(len(self.items), 1)).tolist(), (pairs % max(len(self.items), 1)).tolist(), strict=True)

    def matches(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text its items: item_id, edits, and the word after their last one."""
        out: list[list[dict]] = [[] for _ in texts]
        if not self.items:
            return out
        docs, starts, lengths, of, base, offset = [], [], [], [], [], 0
        for i, text in enumerate(texts):
            symbols = self.symbols(text)
            own = list(self.windows(symbols))
            if not own:
                continue
            for length, at in own:
                starts.append(at + offset)
                lengths.append(np.full(len(at), length))
                of.append(np.full(len(at), len(docs)))
            docs.append((i, symbols, offset))
            base += [symbols, np.zeros(self.longest, np.int64)]
            offset += len(symbols) + self.longest
        if not docs:
            return out
        symbols, starts = np.concatenate(base), np.concatenate(starts)
        lengths, of = np.concatenate(lengths), np.concatenate(of)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for window, item in self.candidates(symbols, starts, lengths):
            doc = int(of[window])
            size = len(self.items[item][1])
            # Keys hold the length, so only windows of the item's size meet it.
            k = allowed(size)
            best = found.get((doc, item))
            if best and best[0] == 0:
                continue
            _, own, first = docs[doc]
            at = int(starts[window]) - first
            begin = max(0, at - k)
            edits, end = nearest(self.items[item][1], own[begin : at + size + k].tolist())
            if edits <= k and (best is None or (edits, begin + end) < best):
                found[doc, item] = (edits, begin + end)
        for (doc, item), (edits, end) in sorted(found.items()):
            out[docs[doc][0]].append({"item_id": self.items[item][0], "edits": edits, "end_word": end})
        return out


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items with an id and text, in blocks of bounded size."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).distinct().collect()
        yield Items(sorted(((r[0], r[1].encode()) for r in own), key=repr))


def type_of(benchmark: DataFrame) -> str:
    return benchmark.schema["item_id"].dataType.simpleString()


def find(docs: DataFrame, items: Items, id_type: str = "bigint") -> DataFrame:
    """Every row of ``docs`` as ``doc``, with its ``matches`` (item_id, edits, end_word)."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    run = text_function(
        f"matches array<struct<item_id:{id_type},edits:int,end_word:int>>",
        lambda texts: {"matches": shared.value.matches(texts)},
    )
    return docs.select(F.struct("*").alias("doc"), run(F.col("text")).alias("out")).select(
        "doc", "out.matches"
    )


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, end_word): every item found in every row.

    Repeated rows give repeated results.  NULL and empty texts and items hold
    nothing.  Ids may be of any type.
    """
    out = None
    for items in blocks(benchmark):
        found = find(docs.select("doc_id", "text"), items, type_of(benchmark))
        rows = found.select("doc.doc_id", F.inline("matches"))
        out = rows if out is None else out.unionByName(rows)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    for items in blocks(benchmark):
        docs = find(docs, items, type_of(benchmark)).where(F.size("matches") == 0).select("doc.*")
    return docs
