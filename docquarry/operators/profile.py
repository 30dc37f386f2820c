"""Looking at tables: counts, summary statistics, look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.idsets import id_blocks, set_digests, sizes
from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise


def profile(docs: DataFrame) -> DataFrame:
    """Rows, distinct ids and distinct texts; null counts as a value.

    Every column is counted by its own partial groups, so no row is multiplied by the
    number of columns. Texts are compared by their SHA-256 digest: 32 bytes are shuffled
    per distinct text and not the text.
    """
    digest = F.unhex(F.sha2("text", 256))
    none, one = F.lit(0).cast("long"), F.count("*")
    by_id = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    ids = by_id.agg(F.coalesce(F.sum("n"), none).alias("n_rows"), one.alias("n_ids"), none.alias("n_texts"))
    texts = docs.select(digest.alias("digest")).distinct()
    texts = texts.agg(none.alias("n_rows"), none.alias("n_ids"), one.alias("n_texts"))
    both = ids.unionByName(texts)
    return both.agg(*[F.sum(name).alias(name) for name in ("n_rows", "n_ids", "n_texts")])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) of columns, in one pass.

    Minimum and maximum are written as text, in the column's own order; mean and
    deviation of text columns are null.
    """
    sums = []
    for c in columns:
        text = isinstance(df.schema[c].dataType, T.StringType)
        value = F.lit(None).cast("double") if text else F.col(c).cast("double")
        sums.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("stddev"),
                F.min(c).cast("string").alias("min"),
                F.max(c).cast("string").alias("max"),
            )
        )
    return df.agg(F.array(*sums).alias("all")).select(F.inline("all"))


def lookup_document(docs: DataFrame, doc_id: int) -> DataFrame:
    return docs.filter(F.col("doc_id") == doc_id)


def question_contexts(qrels: DataFrame, questions: DataFrame, contexts: DataFrame, keys: list[str]):
    """(keys, question, context): one row per judgment (keys, doc_id); ``contexts`` is
    (doc_id, context) of the judged documents."""
    asked = qrels.join(broadcast_if_small(questions), keys)
    return asked.join(contexts, "doc_id").select(*keys, "question", "context")


def context_per_id_set(qrels: DataFrame, contexts: DataFrame, keys: list[str]) -> DataFrame:
    """(n_ids, first_id, context): one row per distinct set of relevant ids, with its
    smallest context.

    Sets are compared by digests of their bitmaps, so no list of ids is ever put together.
    """
    sets = qrels.groupBy(*keys).agg(F.min("doc_id").alias("first_id"))
    blocks = materialise(id_blocks(qrels, keys), "id-sets")
    sets = sets.join(sizes(blocks, keys), keys).join(set_digests(blocks, keys), keys)
    pairs = qrels.join(broadcast_if_small(materialise(sets, "sets")), keys).join(contexts, "doc_id")
    grouped = pairs.groupBy("digest").agg(
        F.first("n_ids").alias("n_ids"), F.first("first_id").alias("first_id"), F.min("context").alias("context")
    )
    return grouped.select("n_ids", "first_id", "context")
