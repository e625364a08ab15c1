"""Connected components by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import _store


def _with_least(e: DataFrame) -> DataFrame:
    """Each directed edge (u, v) with m: the least neighbour of u."""
    return e.join(e.groupBy("u").agg(F.min("v").alias("m")), "u")


def _large(e: DataFrame) -> DataFrame:
    both = _with_least(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    return both.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    near = _with_least(e)
    return (
        near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        .where("u != v").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots; root: the least node reachable."""
    e = _store.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    last = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last, old = now, e
        e = _store.table(_small(_large(e)), "edges")
        _store.drop(old)
