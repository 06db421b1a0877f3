"""Phrases: frequent n-grams by Misra-Gries summaries, exact counts, scores of their cuts.

First pass: each block of texts sums up its n-grams as sorted hashed keys with
counts, cut by the leading bits of the key into parts.  The summaries of a part are
merged one after the other into at most k counters, k being well above the part's
mass divided by the threshold: where more are left, the (k+1)-th largest count is taken
from all.  What is taken from one key in all merges together stays below the
threshold, so every frequent n-gram survives; the sum of what was taken bounds each
key's true count from above and rules out most others.

Second pass: each block is told which of its keys survived, and counts these n-grams
by their words.  The sums are exact; keys that met by chance fall out here.

Texts: A-Z in lower case; cut at PIECE_END into pieces and these at space and tab
into words.  NULL and '' have none.  A NULL language counts as ``und``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.blocks import blocks, pack_numbers, pack_sorted, parts_of, unpack_numbers, unpack_sorted
from velotide.llm.common import mix, pack, raw, saved, text_bytes, unpack

#: Words of the longest phrase.
LONGEST = 5
#: Least number of occurrences.
THRESHOLD = 100
#: A phrase goes if a longer one that holds it has so many hundredths of its occurrences.
ABSORB = 100
#: Phrases listed per language.
TOP = 2000
#: Counters of a summary for each that the guarantee needs: what is taken from a key, and so
#: the number of those kept without being frequent, falls with it.
ROOM = 10
UNKNOWN = "und"
#: What ends a piece.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
#: Bytes of text in a block, in a stretch that is split at a time, and for a part of the keys.
BLOCK_BYTES, CHUNK, PART_BYTES = 4 << 20, 1 << 18, 4 << 20

_PLAIN = bytes.maketrans(
    PIECE_END + b"\t" + bytes(range(65, 91)), b"\n" * len(PIECE_END) + b" " + bytes(range(97, 123))
)


class Words:
    """The words of texts in one language or several, as numbers.

    ``ids``: each word's place in ``names``; ``piece``: the number of its piece.
    """

    def __init__(self, texts: list[tuple[str, bytes]]):
        ids, pieces, self.names, self.langs = [], [], [], []
        self.counts: dict[str, int] = {}
        piece = 0
        for lang, data in texts:
            own: dict[bytes, int] = {}
            self.counts[lang] = 0
            for part in stretches(data):
                chars = np.frombuffer(part, np.uint8)
                apart = (chars == 32) | (chars == 10)
                starts = np.flatnonzero(~apart & np.r_[True, apart[:-1]])
                # What is left of white space is spaces and line feeds, where split() cuts, too.
                words = part.split()
                for w in words:
                    own.setdefault(w, len(self.names) + len(own))
                ids.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
                pieces.append(piece + np.cumsum(chars == 10)[starts])
                piece += int((chars == 10).sum())
                self.counts[lang] += len(words)
            piece += 1
            self.names += own
            self.langs += [lang] * len(own)
        self.ids, self.piece = np.concatenate(ids), np.concatenate(pieces)
        seeds = {lang: xxhash.xxh3_64_intdigest(lang) for lang in self.counts}
        hashes = (xxhash.xxh3_64_intdigest(w, seeds[lang]) for w, lang in zip(self.names, self.langs, strict=True))
        self.hashes = np.fromiter(hashes, np.uint64, len(self.names))

    def keys(self, bits: int) -> Iterator[np.ndarray]:
        """The key of the n-gram at each place, for 1, 2, ... words; a shorter array has fewer places."""
        own = self.hashes[self.ids]
        total = own
        for k in range(LONGEST):
            if k:
                total = mix(total[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[k:])
            yield total >> np.uint64(64 - bits)

    def whole(self, k: int) -> np.ndarray:
        """Whether the n-gram of ``k`` words at each place is in one piece."""
        return self.piece[: len(self.piece) - k + 1] == self.piece[k - 1 :]


def stretches(data: bytes) -> Iterator[bytes]:
    """``data`` in stretches of about CHUNK bytes that end after a white space."""
    start = 0
    while start < len(data):
        end = start + CHUNK
        cut = [at for at in (data.find(b" ", end), data.find(b"\n", end)) if at >= 0]
        end = min(cut) + 1 if cut else len(data)
        yield data[start:end]
        start = end
    if not data:
        yield data


def plain(texts: list[bytes]) -> bytes:
    return b"\n".join(texts).translate(_PLAIN)


def summary(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all n-grams, ascending, with their counts."""
    whole = [words.whole(k) for k in range(1, min(LONGEST, len(words.ids)) + 1)]
    every, at = np.empty(sum(int(w.sum()) for w in whole), np.uint64), 0
    for keys, own in zip(words.keys(bits), whole, strict=False):
        found = keys[own]
        every[at : at + len(found)] = found
        at += len(found)
    every.sort()
    starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
    return every[starts], np.diff(np.r_[starts, len(every)])


class MisraGries:
    """Merges summaries into at most ``k`` counters.

    Summaries are gathered until they hold ``k`` counters, and then merged at once.
    ``taken``: what was taken from every counter so far; a key's true count is at
    most that much more than its counter, or at most that much without one.
    """

    def __init__(self, k: int):
        self.k, self.taken, self.n_waiting = k, 0, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts.astype(np.int64)))
        self.n_waiting += len(keys)
        if self.n_waiting >= self.k:
            self.merge()

    def merge(self) -> None:
        own = [(self.keys, self.counts), *self.waiting]
        self.waiting, self.n_waiting = [], 0
        keys, counts = (np.concatenate(x) for x in zip(*own, strict=True))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        every = keys[starts]
        total = np.add.reduceat(counts, starts) if len(starts) else counts
        if len(every) > self.k:
            least = int(np.partition(total, len(total) - self.k - 1)[len(total) - self.k - 1])
            total = total - least
            self.taken += least
            every, total = every[total > 0], total[total > 0]
        self.keys, self.counts = every, total

    def may_reach(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.taken >= threshold]


def text_blocks(docs: DataFrame) -> DataFrame:
    """(block, langs, texts, sizes): the plain texts of each block, joined by language, and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in blocks(batches, BLOCK_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            texts = [plain(own) for own in by_lang.values()]
            row = {"block": number, "langs": list(by_lang), "texts": [pack(t) for t in texts]}
            yield pa.RecordBatch.from_pylist([row | {"sizes": [len(t.split()) for t in texts]}], TEXTS)

    lang = F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")
    schema = "block bigint, langs array<string>, texts array<binary>, sizes array<bigint>"
    return saved(docs.select(lang, raw(F.col("text")).alias("text")).mapInArrow(run, schema), "phrase-blocks")


TEXTS = pa.schema(
    [("block", pa.int64()), ("langs", pa.list_(pa.string())), ("texts", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))]
)


def words_of(row: dict) -> Words:
    return Words([(lang, unpack(t)) for lang, t in zip(row["langs"], row["texts"], strict=True)])


def summaries(texts: DataFrame, bits: int, shift: int) -> DataFrame:
    """(block, part, mass, keys, counts): the n-grams of each block, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = summary(words_of(row), bits)
                parts, at = parts_of(keys, shift)
                for i in range(0, len(parts), 64):
                    own = parts[i : i + 64].tolist()
                    cuts = [slice(int(j), int(k)) for j, k in zip(at[i : i + 64], at[i + 1 : i + 65], strict=False)]
                    columns = [
                        pa.array([row["block"]] * len(own), pa.int64()),
                        pa.array(own, pa.int64()),
                        pa.array([int(counts[c].sum()) for c in cuts], pa.int64()),
                        pa.array([pack_sorted(keys[c]) for c in cuts], pa.binary()),
                        pa.array([pack_numbers(counts[c]) for c in cuts], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "part", "mass", "keys", "counts"])

    schema = "block bigint, part bigint, mass bigint, keys binary, counts binary"
    return texts.select("block", "langs", "texts").mapInArrow(run, schema)


def survivors(summed: DataFrame, threshold: int) -> DataFrame:
    """(block, part, kept): for each block and part a bit per key, whether it may be frequent."""

    def run(part: pa.Table) -> pa.Table:
        sketch = MisraGries(ROOM * sum(part["mass"].to_pylist()) // threshold + 1)
        for keys, counts in zip(part["keys"], part["counts"], strict=True):
            sketch.add(unpack_sorted(keys), unpack_numbers(counts))
        sketch.merge()
        found = sketch.may_reach(threshold)
        kept = [pack(np.packbits(np.isin(unpack_sorted(k), found)).tobytes()) for k in part["keys"]]
        return pa.table({"block": part["block"], "part": part["part"], "kept": pa.array(kept, pa.binary())})

    return summed.groupBy("part").applyInArrow(run, "block bigint, part bigint, kept binary")


COUNTS = "lang string, phrase string, words int, f bigint"
#: Phrases whose counts a task holds before it hands them on.
HELD = 300_000


def counted(words: Words, bits: int, found: np.ndarray) -> Iterator[tuple[tuple[str, bytes, int], int]]:
    """Exact counts of the n-grams whose keys are among ``found``, by language and words.

    An n-gram is told by the number of all words but its last, and the last.  Where
    a key survives by chance and the shorter n-gram's does not, it isn't frequent.
    """
    names = words.names
    n = len(words.ids)
    same = np.full(n, -1)
    phrases: list[tuple[str, bytes, int]] = []
    for k, keys in enumerate(words.keys(bits), 1):
        if k > n:
            return
        at = np.flatnonzero(words.whole(k))
        if k > 1:  # what is frequent begins and ends with what is
            at = at[(same[at] >= 0) & (same[at + 1] >= 0)]
        at = at[found[np.minimum(np.searchsorted(found, keys[at]), len(found) - 1)] == keys[at]] if len(found) else at[:0]
        pair = words.ids[at] if k == 1 else same[at] * len(names) + words.ids[at + k - 1]
        values, of, times = np.unique(pair, return_inverse=True, return_counts=True)
        if k == 1:
            phrases = [(words.langs[v], names[v], 1) for v in values.tolist()]
        else:
            first, last = (values // len(names)).tolist(), (values % len(names)).tolist()
            phrases = [
                (phrases[i][0], phrases[i][1] + b" " + names[j], k) for i, j in zip(first, last, strict=True)
            ]
        same = np.full(n - k + 1, -1)
        same[at] = of
        yield from zip(phrases, times.tolist(), strict=True)


def handed_on(held: Counter, parts: int) -> Iterator[pa.RecordBatch]:
    """The counts a task holds, as a row for each part of the phrases."""
    dealt: dict[int, list[tuple]] = {}
    for (lang, phrase, k), f in held.items():
        dealt.setdefault(zlib.crc32(phrase) % parts, []).append((lang, phrase.decode(), k, f))
    for part, rows in dealt.items():
        lists = [pa.array([c], pa.list_(t)) for c, (_, t) in zip(zip(*rows, strict=True), COUNTS_FIELDS, strict=True)]
        names = ["part", *(name for name, _ in COUNTS_FIELDS)]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *lists], names)


HANDED = "part bigint, lang array<string>, phrase array<string>, words array<int>, f array<bigint>"


def added_up(part: pa.Table, threshold: int) -> pa.Table:
    """The sums of a part's counts that reach the threshold."""
    columns = {name: pa.chunked_array([c.flatten() for c in part[name].chunks], t) for name, t in COUNTS_FIELDS}
    total = pa.table(columns).group_by(["lang", "phrase", "words"]).aggregate([("f", "sum")])
    total = total.filter(pc.greater_equal(total["f_sum"], threshold))
    return pa.table([total[c] for c in ("lang", "phrase", "words", "f_sum")], schema=pa.schema(COUNTS_FIELDS))


def frequent(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all n-grams of 1 to LONGEST words with ``threshold`` or more
    occurrences, and (lang, n), the number of words of each language."""
    size = text_bytes(docs)
    # Keys with some bits more than there are n-grams seldom meet by chance.
    bits = min(64, max(size, 1).bit_length() + 5)
    shift = min(63, max(0, bits - (size // PART_BYTES).bit_length()))
    n_parts = 1 << (bits - shift)
    texts = text_blocks(docs)
    words = texts.select(F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("sizes").alias("n"))))
    n = words.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, bytes, int]] = Counter()
        for row in (r for batch in batches for r in batch.to_pylist()):
            words = words_of(row)
            keys, _ = summary(words, bits)
            parts, at = parts_of(keys, shift)
            flags = [np.unpackbits(np.frombuffer(unpack(t["kept"]), np.uint8)) for t in row["told"] or []]
            flags = [f[: j - i] for f, i, j in zip(flags, at[:-1].tolist(), at[1:].tolist(), strict=True)]
            found = keys[np.concatenate([*flags, np.empty(0, np.uint8)]).astype(bool)]
            del keys
            # The blocks of a task are added up before anything is handed on.
            for phrase, f in counted(words, bits, found):
                held[phrase] += f
            if len(held) >= HELD:
                yield from handed_on(held, n_parts)
                held.clear()
        yield from handed_on(held, n_parts)

    told = survivors(summaries(texts, bits, shift), threshold)
    told = told.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "kept"))).alias("told"))
    own = texts.select("block", "langs", "texts").join(told, "block", "left")
    rows = own.select("langs", "texts", "told").mapInArrow(run, HANDED)
    total = rows.groupBy("part").applyInArrow(lambda part: added_up(part, threshold), COUNTS)
    return saved(total, "phrases"), saved(n, "phrase-words")


COUNTS_FIELDS = [("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]


def part_of(words: Column, first, size) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(grams: DataFrame, n: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score): each phrase of several words with its worst cut.

    Products are decimals of 38 digits; beyond them the query fails, it never rounds.
    """
    split = F.split("phrase", " ")
    phrases = grams.where("words > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    phrases = phrases.select(
        "lang", "phrase", "words", F.col("f").alias("a"), "cut",
        part_of(split, F.lit(1), F.col("cut")).alias("first"),
        part_of(split, F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"),
    )
    left = grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = phrases.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(n, "lang")

    def exact(c: str, digits: int = 19) -> str:
        return f"cast({c} as decimal({digits},0))"

    score = F.expr(f"({exact('a')} * {exact('n')} * 1000BD) div ({exact('l')} * {exact('r')})")
    worst = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w")
    out = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(worst)
    return out.select("lang", "phrase", "words", "a", "w.l", "w.r", "n", "w.score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """Per language the ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to LONGEST words with at least ``threshold`` occurrences ``a`` is a
    candidate.  ``l`` and ``r`` are those of the parts of its worst cut, ``n`` all words of
    the language.  A candidate goes if its words lie within a longer one as frequent.
    Of equal scores and ``a`` the lesser phrase, by its bytes, comes first.  Repeated
    rows count each; a language without candidates has no rows.
    """
    grams, n = frequent(docs.select("lang", "text"), threshold)
    longer = grams.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    within = longer.select("lang", part_of(F.split("phrase", " "), F.col("at"), F.col("size")).alias("phrase"), "f")
    within = within.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    rows = scored(grams, n).join(within, ["lang", "phrase"], "left")
    rows = rows.where(F.col("most").isNull() | (100 * F.col("most") < ABSORB * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
