"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import saved


def stars(edges: DataFrame, least: str) -> DataFrame:
    """Replace a node's edges by edges to its least neighbour (or itself).

    ``least``: 'large' links the larger neighbours, 'small' the smaller ones.
    The minimum combines within tasks, and only it meets the edges again, so a
    node with very many neighbours is never gathered.
    """
    if least == "large":
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        new = both.join(low, "u").where(F.col("v") > F.col("u"))
        return new.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    new = down.join(low, "u")
    linked = new.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that isn't its component's least node."""
    edges, before = saved(edges.where("u != v").select("u", "v").distinct(), "graph"), None
    while True:
        h = F.xxhash64("u", "v")
        now = edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
        if now == before:  # the same stars as a round ago
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges, before = saved(stars(stars(edges, "large"), "small"), "graph"), now
