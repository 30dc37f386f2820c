"""Cutting a corpus and its labels down together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SORTED_IDS = 65_536  # ids that one task may sort
SKETCH = 10_000  # accuracy of the quantile sketch


def nth_smallest(docs: DataFrame, n: int) -> int | None:
    """The n-th smallest id of ``docs`` (ids are unique), the largest if there are fewer,
    None if there is none.

    A quantile sketch gives a narrow range around it, exact counts say how many ids lie
    below; the range is narrowed until a task may sort what is in it.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    row = ids.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if n < 1 or not row.n:
        return None
    if n >= row.n:
        return row.high
    low, high, below, inside = row.low, row.high, 0, row.n
    while inside > SORTED_IDS:
        within = ids.filter(F.col("doc_id").between(low, high))
        share, margin = (n - below) / inside, 4 / SKETCH
        around = [max(0.0, share - margin), min(1.0, share + margin)]
        first, last = within.agg(F.percentile_approx("doc_id", around, SKETCH).alias("q")).first().q
        # the sketch may be off: the range is moved to where the counts say the id is
        counted = within.agg(
            F.count(F.when(F.col("doc_id") < first, 1)).alias("under"),
            F.count(F.when(F.col("doc_id") <= last, 1)).alias("up_to"),
        ).first()
        if below + counted.under >= n:
            high, inside = first - 1, counted.under
        elif below + counted.up_to < n:
            low, below, inside = last + 1, below + counted.up_to, inside - counted.up_to
        else:
            low, high, below, inside = first, last, below + counted.under, counted.up_to - counted.under
    nearest = ids.filter(F.col("doc_id").between(low, high)).orderBy("doc_id").limit(n - below)
    return nearest.agg(F.max("doc_id").alias("last")).first().last


def first_documents(docs: DataFrame, n: int) -> DataFrame:
    """The n documents with the smallest ids (ids are unique); texts are filtered in place."""
    last = nth_smallest(docs, n)
    return docs.filter(F.col("doc_id") <= last) if last is not None else docs.limit(0)


def documents_up_to(docs: DataFrame, cutoff: int) -> DataFrame:
    return docs.filter(F.col("doc_id") <= cutoff)


def labels_up_to(labels: DataFrame, cutoff: int) -> DataFrame:
    """Keeps the ids up to the cut-off and the rows that still have one."""
    kept = F.filter("cid", lambda doc_id: doc_id <= cutoff)
    return labels.withColumn("cid", kept).filter(F.size("cid") > 0)


def judgments_within(qrels: DataFrame, sample: DataFrame) -> DataFrame:
    """Judgments whose document is a member of the sample."""
    return qrels.join(sample.select("doc_id"), "doc_id", "left_semi")
