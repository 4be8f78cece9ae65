"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours move to the least of the neighbourhood; small star: the others do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    moved = both.join(least, "u")
    if large:
        moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(least.select("u", F.col("low").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that ``edges`` (u, v: long, not null) touches; label is the least node of its component.

    Alternating large and small stars: each pass is a map-side combined
    minimum and a join, written to the shared folder. It ends when a pass
    changes nothing. Edges from a node to itself say nothing and give no row.
    """
    now = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = None
    while True:
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == state or not row["n"]:
            break
        state = (row["n"], row["h"])
        now = materialise(_stars(_stars(now, True), False), "cc")
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return pairs.unionByName(pairs.select(F.col("label").alias("node"), "label").distinct())
