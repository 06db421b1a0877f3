"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a document's hash.  A bucket
whose documents exceed the byte limit splits on the next bit; others stay.  The
sizes of all buckets come from one histogram over longer prefixes; buckets still
too large at its end are refined in a further round over their documents alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import saved

#: Bits of hash: 15 hexadecimal digits fit a long.
BITS = 60


def hash_bits(*columns: str) -> Column:
    """60 bits of the MD5 of the values; NULL differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int, step: int = 12) -> DataFrame:
    """Buckets (depth, prefix, bytes, n_docs, oversize) of rows with ``bits`` and ``size``.

    A round covers ``step`` bits; the next one reads the rows of buckets that are
    too large at its last bit.  A bucket too large at bit BITS holds one hash
    only; it is marked oversize.
    """
    leaves, start, pending = None, 0, rows.select("bits", "size")
    while True:
        end = min(start + step, BITS)
        first = start + 1 if start else 0
        cells = pending.groupBy(F.expr(f"shiftright(bits, {BITS - end})").alias("cell")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n_docs")
        )
        depths = F.explode(F.sequence(F.lit(first), F.lit(end))).alias("depth")
        sums = saved(
            cells.select(depths, "cell", "bytes", "n_docs")
            .groupBy("depth", F.expr(f"shiftright(cell, {end} - depth)").alias("prefix"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("n_docs").alias("n_docs")),
            "shard-sums",
        )
        large = F.col("bytes") > limit
        # A bucket exists if the one it split from, its parent, was too large.
        split = sums.where(large).select(
            (F.col("depth") + 1).alias("depth"),
            F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
        )
        below = sums.where(F.col("depth") > first).join(split, ["depth", "prefix"], "left_semi")
        reached = sums.where(F.col("depth") == first).unionByName(below)
        done = reached.where(~large | (F.col("depth") == BITS)).withColumn("oversize", large)
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = reached.where(large & (F.col("depth") == end)).select("prefix")
        if end == BITS or rest.isEmpty():
            return leaves
        pending = pending.withColumn("prefix", F.expr(f"shiftright(bits, {BITS - end})"))
        pending = pending.join(rest, "prefix", "left_semi").select("bits", "size")
        start = end


def placed(rows: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """``rows``, which have bits, size and doc_id, with ``depth`` and ``shard``; each row stays one."""
    # Hashes spread evenly, so buckets have few depths; a row meets its bucket at one of them.
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())
    at = F.explode(F.array(*map(F.lit, depths)).cast("array<int>")).alias("depth")
    found = (
        rows.select("*", at)
        .withColumn("prefix", F.expr(f"shiftright(bits, {BITS} - depth)"))
        .join(leaves.select("depth", "prefix", "oversize", "n_docs"), ["depth", "prefix"])
    )
    digits = F.conv(F.col("prefix").cast("string"), 10, 2)
    found = found.withColumn(
        "shard", F.when(F.col("depth") == 0, "").otherwise(F.lpad(digits, F.col("depth"), "0"))
    )
    several = F.col("oversize") & (F.col("n_docs") > 1)
    copies = Window.partitionBy("bits").orderBy("doc_id")
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("size")))
    piece = F.floor((F.row_number().over(copies) - 1) / each).cast("string")
    cut = found.where(several).withColumn("shard", F.concat("shard", F.lit("+"), piece))
    return found.where(~several).unionByName(cut)


def sized() -> list[str | Column]:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return ["doc_id", hash_bits("doc_id", "text").alias("bits"), size.alias("size")]


def assign(docs: DataFrame, limit: int) -> DataFrame:
    """Per row doc_id, bytes, depth and shard (the bits of its prefix; '' is the whole).

    Rows are hashed by id and text; a NULL text has no bytes.  A row larger than
    the limit is a shard of its own.  Repeated rows share all bits: where they
    alone exceed the limit, '+k' numbers the pieces they are cut into.
    """
    rows = saved(docs.select(*sized()), "shard-rows")
    leaves = saved(directory(rows, limit), "shard-directory")
    return placed(rows, leaves, limit).select("doc_id", F.col("size").alias("bytes"), "depth", "shard")


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Store each shard as a folder ``shard=<bits>`` of whole rows of ``docs``.

    A row carries its own bits to its shard, so rows that share an id, have none
    or are repeated are each written once.  A column ``shard`` of ``docs`` gives
    way to that of the folder.
    """
    leaves = saved(directory(docs.select(*sized()), limit), "shard-directory")
    rows = placed(docs.select(F.struct("*").alias("doc"), *sized()), leaves, limit)
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c != "shard"]
    rows = rows.select(*kept, F.concat(F.lit("b"), "shard").alias("shard"))
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
