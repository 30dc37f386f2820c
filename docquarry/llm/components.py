"""Connected components of an edge table, by alternating large and small stars.

Each star is one minimum per node and one join back; edges shrink towards stars around
the smallest id of every component. Rounds go to written tables. Minima combine before
the shuffle, and the joined side has one row per node, so a node with very many edges is
split by Spark's skew handling. Only counts reach the driver.

Defined results: edges with a null end and loops are ignored; nodes without an edge are
not in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.sources.shared import materialise


def _star(edges: DataFrame) -> DataFrame:
    """(a, b), a > b, once each."""
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _large(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of a node to its smallest one (or to itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").filter("b > a").select(
        F.col("b").alias("a"), F.least("a", "m").alias("b")
    )


def _small(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node in ``edges`` (a, b); the component is its smallest id."""
    now = materialise(_star(edges.select("a", "b")), "edges")
    state = None
    while True:
        told = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
        if told == state or told.n == 0:
            break
        state = told
        now = materialise(_star(_small(_star(_large(now)))), "edges")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
