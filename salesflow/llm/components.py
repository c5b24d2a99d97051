"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import stored


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (large: the greater ones; else the smaller ones and itself) are hung on the least of them all."""
    around = edges.union(edges.select("v", "u")) if large else edges
    least = stored(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    met = around.join(least, "u")
    moved = met.where("v > u") if large else met
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) for every node of ``edges`` (two long columns, any order, loops ignored).

    A node's neighbours are folded to their least before they are joined back, both sides plain tables, so that a hub's rows can be split
    between tasks. Every round is written to the shared folder; the driver sees only a count and a checksum of it.
    """
    a, b = edges.columns[:2]
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if mark == seen:
            break
        seen = mark
        now = stored(_starred(_starred(now, True), False), "edges")
    roots = now.select(F.col("v").alias("node")).distinct()
    return stored(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component"))), "components")
