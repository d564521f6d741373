"""Connected components of a graph given by its edges, by alternating stars (Kiveris et al.)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) for every node of an edge between different nodes; label is the smallest node of its component.

    ``edges`` has two bigint columns (a, b). Every round is two aggregations that combine before
    their shuffle and two joins of edges; no component is ever gathered in one place. The rounds
    grow with the logarithm of the longest path.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of a node hangs on the smallest of the node and its neighbours
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: every smaller neighbour, and the node, hang on the smallest neighbour
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = written(small.filter("a <> b").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b")).distinct()
