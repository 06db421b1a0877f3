"""Long repeated passages, by a run-length index of the Burrows-Wheeler transform.

Every byte covered by a string of LENGTH bytes that also starts elsewhere is
marked, across and within texts.  A string of LENGTH bytes is called a window.

1. Anchors bring together what may match.  A window's anchor is the position in
   it with the least hash of GRAM bytes; equal windows have theirs at the same
   place.  About one position in 185 is an anchor, for a run of windows.
2. Runs of windows that equal another run as a whole are marked at once, by a
   hash of all their bytes.  Runs whose anchor occurs in one place only are done
   with.  The rest goes on; of equal runs, one for all.
3. The rest is cut in blocks of SPAN windows, at fixed distances from the anchor.
   All windows of a block share its core of LENGTH - SPAN + 1 bytes.  Step 2 is
   applied to blocks, with the hash of the core in place of the anchor.
4. What is left are blocks in which matches begin or end.  Each is shortened to
   the bytes before the core, one symbol for the core, and the bytes after it.  A
   task builds the Burrows-Wheeler transform of its shortened blocks, keeps it as
   runs, and samples the longest common prefix with the neighbouring suffix at
   the ends of runs.  Between samples it falls by one with each step through the
   text, so that streaming through the text from sample to sample gives the
   longest match elsewhere at every position.

A core with very many blocks would make one task large.  Those are resolved
without an index, by halving blocks until each half is decided by step 2.

NULL counts as the empty text.  Repeated rows are different places, so all their
windows are marked.

Passages of PASSAGE words may be shorter than LENGTH bytes.  ``sharing`` tells the
rows that hold one which another row holds, too, by anchors of words.  A row with
a run that another row holds as a whole is settled by step 2.  For the others, the
windows of the anchors that they share are compared one by one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import checkpointed, mix, pack, partitions_for, raw, saved, text_bytes, unpack

LENGTH, GRAM, SPAN = 400, 32, 41
#: Grams of a window, less one: 9 blocks of SPAN windows share an anchor.
REACH = LENGTH - GRAM
#: The same in words, for passages of over 50 words.
PASSAGE, WORD_GRAM = 51, 8
#: Bytes of texts hashed at a time, and symbols in one index.
CHUNK, INDEX = 1 << 21, 1 << 20
#: A core with more blocks is resolved by halving.
MANY = 4096
#: Blocks in a batch.
BLOCKS = 1 << 15
#: Bytes of texts whose words are hashed at a time, and anchors of words looked at together.
WORD_CHUNK, MEETING = 1 << 18, 1 << 16
#: Bytes of text in a partition.
TEXT_BYTES = 128 << 20

_bytes = np.random.default_rng(77).integers(0, 2**63, 256, np.uint64)
_odd = np.uint64(0x9E3779B97F4A7C15)
_inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_space = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each position on; never 0."""
    return joint_hashes(_bytes[b], GRAM)


def joint_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` (a power of 2) symbols from each position on, by doubling; never 0."""
    n, factor = 1, 0x9E3779B97F4A7C15
    while n < width:
        h = h[:-n] * np.uint64(factor) + h[n:]
        factor = factor * factor * 3 % 2**64
        n *= 2
    return mix(h) | np.uint64(1)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each stretch of ``width`` values, by doubling."""
    n = 1
    while 2 * n <= width:
        x = pick(x[:-n], x[n:])
        n *= 2
    return pick(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def fold(seed: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    for p in parts:
        seed = mix(seed * _odd + p.astype(np.uint64))
    return seed


def runs(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The anchors of the texts' windows.

    text: number of the text; at: the anchor; first, n: the windows it is the
    anchor of; anchor: hash of its gram; whole: hash of all bytes of its windows.
    """
    own = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    joined = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
    found = anchored(_bytes[joined], np.array([len(texts[i]) for i in own], np.int64), LENGTH, GRAM)
    return found | {"text": np.array(own, np.int64)[found["text"]]}


def anchored(symbols: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """``runs`` of texts of ``sizes`` symbols, ``length`` at least; ``symbols`` are hashes."""
    names = ("text", "at", "first", "n", "anchor", "whole")
    if not len(sizes):
        return {k: np.empty(0, np.int64) for k in names}
    ends = np.cumsum(sizes)
    h, reach = joint_hashes(symbols, gram), length - gram
    low = sliding(h, reach + 1, np.minimum)
    # Windows across the border of two texts are none.
    counts = np.stack([sizes - length + 1, np.full(len(sizes), length - 1)], 1).ravel()
    low[~np.repeat(np.tile([True, False], len(sizes)), counts)[: len(low)]] = 0
    edge = np.zeros(reach, np.uint64)
    highest = sliding(np.r_[edge, low, edge], reach + 1, np.maximum)
    at = np.flatnonzero((highest == h) & (highest > 0))
    # The stretch of windows around each anchor that have its hash as their least.
    start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    stop = np.r_[start[1:], len(low)] - 1
    run = np.searchsorted(start, np.clip(at - reach, 0, len(low) - 1), "right") - 1
    wrong = np.flatnonzero(low[start[run]] != h[at])
    while len(wrong):
        run[wrong] += 1
        wrong = wrong[low[start[run[wrong]]] != h[at[wrong]]]
    first, last = np.maximum(start[run], at - reach), np.minimum(stop[run], at)
    size = last - first + length
    whole = fold((at - first).astype(np.uint64) + np.uint64(1), size)
    for k in range(0, reach + length, gram):
        inside = np.minimum(first + k, first + size - gram)
        whole = np.where(k < size, fold(whole, h[inside]), whole)
    of = np.searchsorted(ends, at, "right")
    begin = (ends - sizes)[of]
    return {
        "text": of,
        "at": at - begin,
        "first": first - begin,
        "n": last - first + 1,
        "anchor": h[at].view(np.int64),
        "whole": whole.view(np.int64),
    }


@functools.lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers below ``n`` of a number, and of its inverse."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x)]) for x in (_odd, _inverse))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the texts, and how many words each text has."""
    b = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    edges = np.flatnonzero(np.diff(~_space[b], prepend=False))
    start, stop = edges[::2], edges[1::2]
    power, back = powers(1 << len(b).bit_length())
    # Sums before each byte; those of a word, as if it were the first.
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_bytes[b] * power[: len(b)], out=sums[1:])
    h = mix((sums[stop] - sums[start]) * back[start])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


def word_runs(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The anchors of the texts' windows of PASSAGE words; of equal runs in a text, one.

    text: number of the text; spot: first window * 64 + windows - 1; anchor, whole: hashes.
    """
    h, counts = word_hashes(texts)
    long = counts >= PASSAGE
    found = anchored(h[np.repeat(long, counts)], counts[long], PASSAGE, WORD_GRAM)
    text, anchor, whole = np.flatnonzero(long)[found["text"]], found["anchor"], found["whole"]
    one = np.unique(fold(text.astype(np.uint64) + np.uint64(1), anchor, whole), return_index=True)[1]
    spot = found["first"] * 64 + found["n"] - 1
    return {"text": text[one], "spot": spot[one], "anchor": anchor[one], "whole": whole[one]}


def word_windows(texts: list[bytes], spots: list[list[int]]) -> dict[str, np.ndarray]:
    """text: number of the text; window: hashes of the distinct windows of its spots."""
    h, counts = word_hashes(texts)
    h = joint_hashes(h, 32)
    spot = np.concatenate([np.asarray(s, np.int64) for s in spots])
    text = np.repeat(np.arange(len(texts)), [len(s) for s in spots])
    first, n = (np.cumsum(counts) - counts)[text] + spot // 64, spot % 64 + 1
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pair = np.stack([np.repeat(text, n), fold(h[at], h[at + PASSAGE - 32]).view(np.int64)])
    text, window = np.unique(pair, axis=1)
    return {"text": text, "window": window}


def blocks(text: bytes, spots: list[dict]) -> dict[str, np.ndarray]:
    """Blocks of the windows of anchors: at, block, low and high (the distances from
    window to anchor that they cover), core and whole (hashes)."""
    h = gram_hashes(np.frombuffer(text, np.uint8))
    at, first, n = (np.array([s[c] for s in spots], np.int64) for c in ("at", "first", "n"))
    high, low = at - first, at - first - n + 1
    many = high // SPAN - low // SPAN + 1
    one = np.repeat(np.arange(len(at)), many)
    block = low[one] // SPAN + np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many)
    at, near = at[one], block * SPAN
    far = near + SPAN - 1
    low, high = np.maximum(low[one], near), np.minimum(high[one], far)
    begin, end = at - far + SPAN - 1, at - far + LENGTH  # of the core
    core = block.astype(np.uint64) + np.uint64(1)
    for k in range(0, LENGTH - SPAN + 1, GRAM):
        core = fold(core, h[np.minimum(begin + k, end - GRAM)])
    # The bytes before and after the core are fewer than GRAM + 8.
    start, stop = at - high, at - low + LENGTH
    whole = fold(core, start - begin, stop - end)
    whole = fold(whole, h[start], h[np.minimum(start + 8, end - GRAM)], h[stop - GRAM], h[np.maximum(stop - GRAM - 8, begin)])
    return {"at": at, "block": block, "low": low, "high": high, "core": core.view(np.int64), "whole": whole.view(np.int64)}


def longest_matches(text: np.ndarray, n_symbols: int) -> np.ndarray:
    """For each position, how far what follows equals what follows another position.

    ``text``: symbols below ``n_symbols`` that end in one that occurs once.  The
    suffixes are sorted by doubling.  Only the ends of the runs of the
    Burrows-Wheeler transform are compared with their neighbours.
    """
    n = len(text)
    base = max(n, n_symbols) + 1
    # Each suffix's rank is the place of the first that is like it so far; the end's is -1.
    rank, reach = np.r_[text, -1], 1
    order, slots = np.arange(n), np.arange(n)
    while True:
        # Only suffixes whose place is still open are sorted.
        open_ = order[slots]
        key = rank[open_] * base + rank[np.minimum(open_ + reach, n)] + 1
        by_key = np.argsort(key, kind="stable")
        order[slots], key = open_[by_key], key[by_key]
        new = np.r_[True, key[1:] != key[:-1]]
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        rank[order[slots]] = first
        still = ~(new & np.r_[new[1:], True])
        if not still.any():
            break
        slots = slots[still]
        reach *= 2
    transform = text[order - 1]
    heads = np.flatnonzero(transform[1:] != transform[:-1]) + 1
    a, b = order[heads - 1], order[heads]
    common, live = np.zeros(len(heads), np.int64), np.arange(len(heads))
    while len(live):
        x, y = a[live] + common[live], b[live] + common[live]
        inside = np.maximum(x, y) < n
        same = inside & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])
        live = live[same]
        common[live] += 1
    best = np.zeros(n, np.int64)
    for sampled, first in ((b, order[0]), (a, order[-1])):
        value, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        value[sampled], place[sampled] = common, sampled
        place[first] = first
        last = np.maximum.accumulate(place)
        fallen = np.where(last >= 0, value[last] - (np.arange(n) - last), 0)
        best = np.maximum(best, fallen)
    return best


def index_matches(rows: pa.Table) -> dict[str, list[int]]:
    """(row, begin, end) of the windows of whole cores' blocks that occur elsewhere in them."""
    before, after = rows["before"].to_pylist(), rows["after"].to_pylist()
    core, number = np.unique(rows["core"].to_numpy(), return_inverse=True)
    m = len(before)
    sizes = np.array([len(x) + len(y) + 2 for x, y in zip(before, after, strict=True)])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    text = np.zeros(ends[-1], np.int64)
    middle = begins + [len(x) for x in before]
    plain = np.ones(len(text), bool)
    plain[middle] = plain[ends - 1] = False
    flanks = b"".join(x for pair in zip(before, after, strict=True) for x in pair)
    text[plain] = np.frombuffer(flanks, np.uint8).astype(np.int64) + m
    text[middle], text[ends - 1] = m + 256 + number, np.arange(m)
    found = longest_matches(text, m + 256 + len(core))
    at, high, low, row = (rows[c].to_numpy() for c in ("at", "high", "low", "row"))
    n = high - low + 1
    one = np.repeat(np.arange(m), n)
    step = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)
    # The window that starts ``step`` into the block is SPAN symbols long here.
    hit = found[begins[one] + step] >= SPAN
    one, step = one[hit], step[hit]
    new = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (step[1:] != step[:-1] + 1)][: len(one)])
    last = np.r_[new[1:], len(one)][: len(new)] - 1
    begin = (at - high)[one] + step
    return {"row": row[one[new]], "begin": begin[new], "end": begin[last] + LENGTH}


def whole_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in runs of about INDEX symbols that don't cut a core."""
    return whole_groups(batches, "core", INDEX // (2 * SPAN))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` in runs of about ``least`` that don't cut a group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= least and held[0][key][0] != batch[key][-1]:
            rows = pa.Table.from_batches(held)
            keys = rows[key].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            yield rows.slice(0, cut)
            held, n = rows.slice(cut).combine_chunks().to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)


def meetings(rows: pa.Table) -> dict[str, np.ndarray]:
    """What rows with equal anchors tell; ``rows`` are all those of some anchors, sorted by anchor.

    With spot -1, each row that has a run of another row.  Else the runs of anchors
    that several rows have in different runs, of equal ones the first; ``shared``
    says that others have it.
    """
    anchor = rows["anchor"].to_numpy()
    like = anchor[1:] == anchor[:-1]
    several = np.flatnonzero(np.r_[False, like] | np.r_[like, False])
    if not len(several):
        return {"row": [], "anchor": [], "spot": [], "shared": []}
    anchor, whole, row, spot = (rows[c].to_numpy()[several] for c in ("anchor", "whole", "row", "spot"))
    order = np.lexsort((row, whole, anchor))
    anchor, whole, row, spot = anchor[order], whole[order], row[order], spot[order]
    new = np.r_[True, anchor[1:] != anchor[:-1]]
    kind = np.flatnonzero(new | np.r_[True, whole[1:] != whole[:-1]])
    low, high = row[kind], row[np.r_[kind[1:], len(row)] - 1]
    shared = low < high
    group = np.flatnonzero(new[kind])
    kinds = np.diff(np.r_[group, len(kind)])
    meet = (kinds > 1) & (np.minimum.reduceat(low, group) < np.maximum.reduceat(high, group))
    settled = np.unique(row[np.repeat(shared, np.diff(np.r_[kind, len(row)]))])
    still = np.flatnonzero(np.repeat(meet, kinds))
    one = kind[still]
    none = np.full(len(settled), -1)
    return {
        "row": np.r_[settled, row[one]],
        "anchor": np.r_[none, anchor[one]],
        "spot": np.r_[none, spot[one]],
        "shared": np.r_[none < 0, shared[still]],
    }


def settle(rows: DataFrame, key: list[str], same: str) -> tuple[DataFrame, DataFrame]:
    """What equals another row in ``key`` and ``same``, and what is still open.

    Open are the rows with a ``key`` that others share but not ``same``; of equal
    ones, one.  All counts combine within tasks first.
    """
    rest = [c for c in rows.columns if c not in (*key, same)]
    kinds = saved(
        rows.groupBy(*key, same).agg(F.count("*").alias("copies"), F.min(F.struct(*rest)).alias("one")),
        "repeat-kinds",
    )
    groups = kinds.groupBy(*key).agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest"))
    groups = groups.where("kinds > 1 AND fewest = 1").select(*key, "kinds")
    equal = rows.join(kinds.where("copies > 1").select(*key, same), [*key, same], "left_semi")
    return equal, kinds.join(groups, key).select(*key, same, "one.*", "kinds")


def halve(rows: DataFrame) -> list[DataFrame]:
    """(row, begin, end) of matched windows of blocks, by cells of 32, 16, ... 1 windows.

    Two blocks' windows in a cell can match only if the bytes common to all
    windows of the cell do; where all bytes of the cell do, they all match.  A
    cell of one window is decided by that.  A block stays open in few cells of
    each width, those in which its matches begin or end.
    """
    out, width = [], 64
    rows = rows.withColumn("near", F.col("block") * SPAN)
    while width > 1:
        width //= 2
        cell = F.explode(F.expr(f"sequence(int((low - near) / {width}), int((high - near) / {width}))"))
        cells = rows.select("core", "row", "at", "near", "low", "high", "before", "after", cell.alias("cell"))
        cells = cells.withColumns(
            {
                "cell_low": F.greatest("low", F.col("near") + F.col("cell") * width),
                "cell_high": F.least("high", F.col("near") + (F.col("cell") + 1) * width - 1),
                "all_low": F.col("cell") * width,
                "all_high": F.least(F.lit(SPAN - 1), (F.col("cell") + 1) * width - 1),
            }
        )
        # Bytes right before and right after the core, of all windows and of any.
        cells = cells.selectExpr(
            "*",
            "substring(before, length(before) - all_low + 1, all_low) AS common_before",
            f"substring(after, 1, {SPAN - 1} - all_high) AS common_after",
            "struct(cell_low, cell_high, "
            "substring(before, length(before) - (cell_high - near) + 1, cell_high - near) AS b, "
            f"substring(after, 1, near + {SPAN - 1} - cell_low) AS a) AS whole",
        )
        cells = cells.select(
            "core", "cell", "common_before", "common_after", "whole",
            "row", "at", "near", "cell_low", "cell_high", "before", "after", "high", "low",
        )
        equal, rest = settle(cells, ["core", "cell", "common_before", "common_after"], "whole")
        out.append(equal.selectExpr("row", "at - cell_high AS begin", f"at - cell_low + {LENGTH} AS end"))
        # A block keeps the bytes that its windows in this cell need.
        rows = rest.selectExpr(
            "core", "row", "at", "near", "cell_low AS low", "cell_high AS high", "whole.b AS before", "whole.a AS after"
        )
    return out


def joined_batch(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})


def find(texts: DataFrame) -> DataFrame:
    """(row, begin, end) of stretches of repeated windows of ``texts`` (row, blob)."""
    spark = texts.sparkSession

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blobs = batch.column(0).to_numpy(), batch.column(1)
            for part in text_chunks(blobs):
                own = runs([unpack(b) for b in blobs.slice(part.start, part.stop - part.start)])
                row = rows[part][own.pop("text")]
                yield pa.RecordBatch.from_pydict({"row": row} | own)

    schema = "row bigint, at bigint, first bigint, n bigint, anchor bigint, whole bigint"
    found = saved(texts.mapInArrow(anchors, schema), "repeat-anchors")
    equal, rest = settle(found, ["anchor"], "whole")
    marked = [equal.selectExpr("row", "first AS begin", f"first + n - 1 + {LENGTH} AS end")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n = [], 0
            for row, blob, spots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = blocks(unpack(blob), spots)
                out.append({"row": np.full(len(own["at"]), row)} | own)
                n += len(own["at"])
                # Not one batch for each text: most have few blocks.
                if n >= BLOCKS:
                    yield joined_batch(out)
                    out, n = [], 0
            if out:
                yield joined_batch(out)

    spots = rest.groupBy("row").agg(F.collect_list(F.struct("at", "first", "n")).alias("spots"))
    schema = "row bigint, at bigint, block bigint, low bigint, high bigint, core bigint, whole bigint"
    cores = saved(texts.join(spots, "row").select("row", "blob", "spots").mapInArrow(cut, schema), "repeat-cores")
    equal, rest = settle(cores, ["core"], "whole")
    marked.append(equal.selectExpr("row", "at - high AS begin", f"at - low + {LENGTH} AS end"))

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, blob, spots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = unpack(blob)
                for s in spots:
                    near = s["block"] * SPAN
                    begin, end = s["at"] - near, s["at"] - near - SPAN + 1 + LENGTH
                    before, after = text[s["at"] - s["high"] : begin], text[end : s["at"] - s["low"] + LENGTH]
                    out.append({"row": row, "before": before, "after": after} | s)
            yield pa.RecordBatch.from_pylist(out, schema=SHORT)

    spots = rest.groupBy("row").agg(
        F.collect_list(F.struct("at", "block", "low", "high", "core", "kinds")).alias("spots")
    )
    schema = (
        "row bigint, at bigint, block bigint, low bigint, high bigint, core bigint, kinds bigint, "
        "before binary, after binary"
    )
    short = saved(
        texts.join(spots, "row").select("row", "blob", "spots").mapInArrow(shorten, schema), "repeat-blocks"
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_cores(batches):
            yield pa.RecordBatch.from_pydict(index_matches(part))

    n = partitions_for(spark, short.count() * 2 * SPAN, 4 * INDEX)
    few = short.where(f"kinds <= {MANY}").repartition(n, "core").sortWithinPartitions("core")
    marked.append(few.mapInArrow(match, "row bigint, begin bigint, end bigint"))
    many = short.where(f"kinds > {MANY}")
    if not many.isEmpty():
        marked += halve(many)
    out = marked[0]
    for more in marked[1:]:
        out = out.unionByName(more)
    return out


def sharing(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (row, blob) with PASSAGE words in a row that another row has, too."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blobs = batch.column(0).to_numpy(), batch.column(1)
            for part in text_chunks(blobs, WORD_CHUNK):
                own = word_runs([unpack(b) for b in blobs.slice(part.start, part.stop - part.start)])
                row = rows[part][own.pop("text")]
                yield pa.RecordBatch.from_pydict({"row": row} | own)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "anchor", MEETING):
            yield pa.RecordBatch.from_pydict(meetings(part), MET)

    found = texts.mapInArrow(anchors, "row bigint, spot bigint, anchor bigint, whole bigint")
    found = found.repartition("anchor").sortWithinPartitions("anchor")
    met = found.mapInArrow(meet, "row bigint, anchor bigint, spot bigint, shared boolean")
    met = saved(met, "repeat-meetings")
    settled = met.where("shared").select("row").distinct()
    runs_met = met.where("spot >= 0")
    # Of a row that is settled, only what others may hold matters.
    wanted = runs_met.where("NOT shared").join(settled, "row", "left_anti").select("anchor").distinct()
    spots = runs_met.join(wanted, "anchor", "left_semi").groupBy("row").agg(F.collect_list("spot").alias("spots"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blobs, spots = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for part in text_chunks(blobs, WORD_CHUNK):
                n = part.stop - part.start
                own = word_windows([unpack(b) for b in blobs.slice(part.start, n)], spots.slice(part.start, n).to_pylist())
                yield pa.RecordBatch.from_pydict({"row": rows[part][own["text"]], "window": own["window"]})

    held = texts.join(spots, "row").select("row", "blob", "spots").mapInArrow(windows, "row bigint, window bigint")
    held = saved(held, "repeat-windows")
    several = held.groupBy("window").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high")
    return settled.unionByName(held.join(several, "window", "left_semi").select("row")).distinct()


REMOVED = [
    ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.binary()),
]
MET = pa.schema([*((c, pa.int64()) for c in ("row", "anchor", "spot")), ("shared", pa.bool_())])
SHORT = pa.schema(
    [(c, pa.int64()) for c in ("row", "at", "block", "low", "high", "core", "kinds")]
    + [("before", pa.binary()), ("after", pa.binary())]
)


def text_chunks(blobs: pa.Array, size: int = CHUNK) -> Iterator[slice]:
    """Ranges of blobs that unpack to about ``size`` bytes."""
    start, n = 0, 0
    for i, b in enumerate(blobs.to_pylist()):
        n += int.from_bytes(b[:8], "little")
        if n >= size:
            yield slice(start, i + 1)
            start, n = i + 1, 0
    if start < len(blobs):
        yield slice(start, len(blobs))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for s in sorted((s["begin"], s["end"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def repeated(docs: DataFrame, passages: bool = False) -> DataFrame:
    """Per row doc_id, n_bytes, ``spans`` (begin, end) of repeated bytes, and ``kept``, the other bytes.

    With ``passages``, shares_passage is 1 if the row holds a passage of over 50
    words that another row holds, too, else 0.
    """
    spark = docs.sparkSession

    @F.pandas_udf("binary")
    def packed(texts):
        return texts.map(pack)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", packed(raw(F.col("text"))).alias("blob")
    )
    # Numbered and dealt out by row once: the joins below find the texts in place.
    n = partitions_for(spark, text_bytes(docs), TEXT_BYTES)
    rows = checkpointed(rows.repartition(n, "row"))
    spans = find(rows.select("row", "blob")).groupBy("row").agg(
        F.collect_list(F.struct("begin", "end")).alias("found")
    )

    joined, own_columns = rows.join(spans, "row", "left"), ["doc_id"]
    if passages:
        joined = joined.join(sharing(rows.select("row", "blob")).withColumn("one", F.lit(1)), "row", "left")
        joined = joined.withColumn("shares_passage", F.coalesce("one", F.lit(0)))
        own_columns.append("shares_passage")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {c: batch[c] for c in own_columns} | {"n_bytes": [], "spans": [], "kept": []}
            for blob, found in zip(batch["blob"].to_pylist(), batch["found"].to_pylist(), strict=True):
                text, own = unpack(blob), merged(found or [])
                at, kept = 0, []
                for begin, end in own:
                    kept.append(text[at:begin])
                    at = end
                out["n_bytes"].append(len(text))
                out["spans"].append([{"begin": b, "end": e} for b, e in own])
                out["kept"].append(b"".join([*kept, text[at:]]))
            # A batch without any span tells no type.
            yield pa.RecordBatch.from_pydict(out, pa.schema([*map(batch.schema.field, own_columns), *REMOVED]))

    joined = joined.select(*own_columns, "blob", "found")
    kinds = [f"{c} {joined.schema[c].dataType.simpleString()}" for c in own_columns]
    schema = ", ".join([*kinds, "n_bytes bigint", "spans array<struct<begin:bigint,end:bigint>>", "kept binary"])
    return joined.mapInArrow(remove, schema)


def report(docs: DataFrame, passages: bool = False) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans, kept_sha256, and removed_share, the part of the
    bytes that goes (0 to 1; of an empty text 0); with ``passages`` shares_passage, as in ``repeated``."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return repeated(docs, passages).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (removed / F.greatest("n_bytes", F.lit(1))).alias("removed_share"),
        *(["shares_passage"] if passages else []),
    )
