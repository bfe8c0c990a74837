"""Connected components by alternating large-star and small-star steps, all on DataFrames.

Edges join two ids of 64 bits. Edges with a null end, loops and repeated edges count for nothing; no edges give no rows. A centre with many edges is one key of a join, which Spark's adaptive joins split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step. Large: of each node, neighbours above it are tied to the least of its neighbours and itself; small: neighbours not above it, and itself."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    tied = near.join(least, "u")
    if small:
        out = tied.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    else:
        out = tied.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, component) of all nodes of the edges (a, b) but the least of each component, whose component is itself. Each step is written to the shared folder."""
    now = stored(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct(), "edges")  # nulls go too
    for _ in range(most):
        for small in (False, True):
            before, now = now, stored(_star(now, small), "edges")
            discard(before)
        # when no centre hangs on another one, every component is a star
        if not now.join(now.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    raise RuntimeError("components did not settle")
