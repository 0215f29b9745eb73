"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared


def connected(links: DataFrame, where: str) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns a, b) but the smallest of each component; the component is named by that one.

    Each round is written below ``where`` and read back. No task sees more of a node than its rows; a hot node is joined,
    which adaptive execution can split, and never gathered.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before, k = shared.stored(edges, f"{where}/edges0"), None, 0
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        k += 1
        edges = shared.stored(small.select("e.u", "e.v").where("u <> v").distinct(), f"{where}/edges{k}")
        shared.removed(edges.sparkSession, f"{where}/edges{k - 1}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
