"""Connected components of an edge table, by alternating large-star and
small-star steps; each step is two shuffles of slim rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import table


def _star(pairs: DataFrame, keep_smaller: bool) -> DataFrame:
    """Of directed pairs ``(u, v)``: each v is tied to the least of u and its
    neighbours. The minimum is combined before the shuffle; a hot u joins one
    row, which AQE can split."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    tied = pairs.join(least, "u")
    if keep_smaller:
        own = least.filter("u <> m").select(F.col("u").alias("v"), "m")
        tied = tied.select("v", "m").union(own)
    else:
        tied = tied.filter("v > u").select("v", "m")
    return tied.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def connected_components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for each node that has an edge; ``component`` is
    the least node of its component. Self loops and repeated edges are fine;
    null ends are dropped; no edges give no rows."""
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    e = table(spark, e, "cc-edges")
    state = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        large = table(spark, _star(both, False), "cc-large")
        e = table(spark, _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), True), "cc-small")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
