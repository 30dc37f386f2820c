"""Weighting formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idf(n_docs: Column, df: Column) -> Column:
    return F.log10((n_docs + 1) / (df + 1)) + 1


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs - df + 0.5) / (df + 0.5) + 1)


def query_weight(qtf: Column, term_idf: Column) -> Column:
    """Sub-linear term frequency on the query side; documents use the raw count."""
    return (F.log10(qtf) + 1) * term_idf


def bm25_weight(
    tf: Column, dl: Column, avgdl: Column, term_idf: Column, k1: float, b: float
) -> Column:
    saturation = tf + k1 * (1 - b + b * dl / avgdl)
    return term_idf * (tf * (k1 + 1)) / saturation


def discounted_gain(rank: Column) -> Column:
    return 1 / F.log2(rank + 1)


def ideal_gain(n_relevant: Column, k: int) -> Column:
    """DCG of a ranking that puts all relevant documents first, cut at k."""
    gains = [
        F.when(n_relevant >= i, discounted_gain(F.lit(i))).otherwise(0.0)
        for i in range(1, k + 1)
    ]
    total = F.lit(0.0)
    for gain in gains:
        total = total + gain
    return total
