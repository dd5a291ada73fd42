"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """`edges` (a, b) with a > b. Each node hands its smallest neighbour, or itself, to its larger (large) or smaller neighbours."""
    arcs = edges.select("a", "b")
    if large:
        arcs = arcs.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join below reads both sides by a plain exchange whose hot partitions Spark splits
    least = keep(arcs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    joined = arcs.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    done = keep(out.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "large-star" if large else "small-star")
    discard(least, edges)
    return done


def components(edges: DataFrame) -> DataFrame:
    """node, root: each node of the undirected `edges` (a long, b long) with the smallest node it is linked with, itself included.
    Repeated edges and loops are harmless; a node that has only a loop gets no row."""
    now = keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    print_ = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    mark = print_(now)
    while mark[0]:
        now = _stars(_stars(now, True), False)
        last, mark = mark, print_(now)
        if mark == last:
            break
    out = keep(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "roots")
    discard(now)
    return out
