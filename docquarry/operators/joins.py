"""Joins that check sizes before they broadcast, and stay even under hot keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_SETTING = "docquarry.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# Postings of one term that a single shuffle partition should hold at most.
SLICE_SETTING = "docquarry.sliceRows"
DEFAULT_SLICE_ROWS = 1_000_000


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_SETTING, str(DEFAULT_BROADCAST_BYTES)))


def slice_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SLICE_SETTING, str(DEFAULT_SLICE_ROWS)))


def _row_bytes(df: DataFrame, extra: int) -> Column:
    """Upper estimate of a row in a broadcast hash table."""
    total = F.lit(32 + extra)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            total = total + 16
    return total.cast("long")


def measure(df: DataFrame, extra: int = 0) -> tuple[int, int]:
    """(rows, bytes) of a table of scalar columns, in one aggregate."""
    row = df.select(_row_bytes(df, extra).alias("b")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")
    ).first()
    return row.n, row.b


def fits(df: DataFrame, extra: int = 0) -> bool:
    return measure(df, extra)[1] <= broadcast_limit(df.sparkSession)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast below the limit; else leave the join to shuffle (AQE splits skew)."""
    return F.broadcast(df) if fits(df) else df


def lookup(
    facts: DataFrame, dim: DataFrame, on: list[str], weight: str, how: str = "inner"
) -> DataFrame:
    """Join many facts to a dimension with one row per key.

    ``dim[weight]`` is how many facts carry the key. A dimension under the
    broadcast limit is broadcast. A larger one is split: its heaviest keys, as
    many as the limit admits, are broadcast, so that no hot key is shuffled; the
    remaining facts, whose keys are light by construction, are joined by shuffle.
    ``facts`` is read twice then and should be a written table.
    """
    limit = broadcast_limit(facts.sparkSession)
    rows, size = measure(dim)
    if size <= limit:
        return facts.join(F.broadcast(dim), on, how)
    head_rows = limit * rows // size
    if head_rows == 0:
        return facts.join(dim, on, how)
    total = dim.agg(F.sum(weight)).first()[0]
    # fewer than total / threshold keys can weigh as much as the threshold
    threshold = total // head_rows + 1
    head = dim.filter(F.col(weight) >= threshold)
    while not fits(head):
        threshold *= 2
        head = dim.filter(F.col(weight) >= threshold)
    tail = dim.filter(F.col(weight) < threshold)
    hot = facts.join(F.broadcast(head), on)
    rest = facts.join(F.broadcast(head.select(*on)), on, "left_anti")
    keyed = reduce(and_, [F.col(key).isNotNull() for key in on])
    cold = rest.filter(keyed).join(tail, on, how)
    if how == "left":  # null keys match nothing and must not meet in one task
        cold = cold.unionByName(rest.filter(~keyed), allowMissingColumns=True)
    return hot.unionByName(cold)
