"""Corpus preparation: one row per document, tokens, stopwords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.text import clean_text, is_kept, kept_tokens, word_tokens
from docquarry.operators.joins import broadcast_limit, measure
from docquarry.sources.shared import materialise


# Stopword lists up to this length are written into the filter expression.
STOPWORDS_IN_PLACE = 10_000


def has_duplicate_ids(docs: DataFrame, key: str = "doc_id") -> bool:
    """Reads and shuffles the id column only."""
    repeated = docs.groupBy(key).count().filter("count > 1")
    return not repeated.limit(1).isEmpty()


def one_row_per_id(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Smallest text of each id; repeated ids are combined before the shuffle."""
    return docs.groupBy(key).agg(F.min("text").alias("text"))


def clean(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with cleaned texts.

    The Arrow UDF inside hides how its input is partitioned. Repartition after
    this step; the steps below it then keep the partitioning.
    """
    return docs.select("doc_id", clean_text(F.col("text")).alias("text"))


def tokenise(cleaned: DataFrame) -> DataFrame:
    """(doc_id, tokens): the kept tokens in text order."""
    return cleaned.select("doc_id", kept_tokens(F.col("text")).alias("tokens"))


def words(cleaned: DataFrame) -> DataFrame:
    """(doc_id, tokens): all words, before any token is dropped."""
    return cleaned.select("doc_id", word_tokens(F.col("text")).alias("tokens"))


def positions(tokens: DataFrame, *carry: str) -> DataFrame:
    """One row per token with its 0-based position.

    A document without tokens gives one row with a null token, so that it is not
    lost. (The outer form also keeps the optimiser from evaluating an expensive
    token array a second time to filter out empty ones.)
    """
    return tokens.select(
        "doc_id", *carry, F.posexplode_outer("tokens").alias("pos", "token")
    )


def regroup(rows: DataFrame) -> DataFrame:
    """Inverse of ``positions``: kept tokens back into one array per document."""
    item = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    ordered = F.sort_array(F.collect_list(item))
    return rows.groupBy("doc_id").agg(ordered.getField("token").alias("tokens"))


def keep_valid(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", F.filter("tokens", is_kept).alias("tokens"))


def drop_stopwords(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Remove the tokens listed in ``stopwords(term)``; repeated tokens stay.

    A list of ordinary length is named in the expression and filters each token array in
    place; a longer one is joined, and one too long to broadcast only with the tokens that
    are not frequent. Nulls in the list mean nothing, documents of stopwords
    only remain as empty ones, whichever way it goes.
    """
    words = stopwords.select(F.col("term").alias("token")).filter(F.col("token").isNotNull())
    words = words.distinct()
    rows, size = measure(words)
    if rows <= STOPWORDS_IN_PLACE and size <= broadcast_limit(tokens.sparkSession):
        named = [row.token for row in words.collect()]
        kept = F.filter("tokens", lambda token: ~token.isin(named))
        return tokens.select("doc_id", kept.alias("tokens"))
    if size <= broadcast_limit(tokens.sparkSession):
        # tokens of empty documents are null and would meet in one task: they come back after
        found = positions(tokens).filter(F.col("token").isNotNull())
        kept = regroup(found.join(F.broadcast(words), "token", "left_anti"))
    else:
        tokens = materialise(tokens, "tokens")
        in_place, light = heavy_and_light(tokens, words)
        kept = regroup(in_place.unionByName(light.join(words, "token", "left_anti")))
    empty = F.coalesce("tokens", F.array().cast("array<string>"))
    return tokens.select("doc_id").join(kept, "doc_id", "left").select("doc_id", empty.alias("tokens"))


HEAVY_BYTES = 256  # of a heavy token in a broadcast table


def heavy_and_light(tokens: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, pos, token) of the frequent tokens that are not among ``words``, decided in
    place, and of all other tokens, none of which is frequent.

    The frequent ones, listed or not, are as many as may be broadcast. ``tokens`` is read
    several times and should be a written table.
    """
    limit = broadcast_limit(tokens.sparkSession)
    found = positions(tokens).filter(F.col("token").isNotNull())
    most = limit // HEAVY_BYTES
    if not most:
        return found.limit(0), found
    counts = materialise(found.groupBy("token").agg(F.count("*").alias("n")), "token-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    # fewer than total / threshold tokens can be as frequent as the threshold
    threshold = total // most + 1
    listed = words.withColumn("listed", F.lit(True))

    def heavy():
        return counts.filter(F.col("n") >= threshold).join(listed, "token", "left").select(
            "token", F.coalesce("listed", F.lit(False)).alias("listed")
        )

    while measure(heavy())[1] > limit:
        threshold *= 2
    marked = found.join(F.broadcast(heavy()), "token", "left")
    in_place = marked.filter(~F.col("listed")).drop("listed")
    light = marked.filter(F.col("listed").isNull()).drop("listed")
    columns = ["doc_id", "pos", "token"]
    return in_place.select(*columns), light.select(*columns)


def frequent_terms(terms: DataFrame, n_docs, share: float) -> DataFrame:
    """Stopword list from the corpus: terms found in more than ``share`` of it.

    At most (mean distinct terms per document) / share terms can qualify.
    """
    return terms.filter(F.col("df") > share * n_docs).select("term")
