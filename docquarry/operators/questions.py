"""Questions as weighted term vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import weights
from docquarry.functions.text import clean_text
from docquarry.operators.compounds import token_arrays
from docquarry.operators.joins import fits, lookup
from docquarry.sources.shared import materialise


def question_tokens(
    questions: DataFrame,
    keys: list[str],
    lexicon: DataFrame | None = None,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """(keys, term, qtf): the text preparation of the corpus, on questions.

    ``keys`` tell the questions apart; ``lexicon`` and ``stopwords`` are those of the index.
    """
    cleaned = questions.select(F.struct(*keys).alias("doc_id"), clean_text(F.col("question")).alias("text"))
    tokens = token_arrays(cleaned, lexicon, stopwords)
    rows = tokens.select("doc_id.*", F.explode_outer("tokens").alias("term"))
    return (
        rows.filter(F.col("term").isNotNull())
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("qtf"))
    )


# What a question vector row holds besides keys, term and qtf, in bytes.
VECTOR_EXTRA = 5 * 16


def vectors_fit(tokens: DataFrame) -> bool:
    """Whether the vectors of these question tokens may be broadcast.

    Joining the vocabulary can only drop rows, so the size of the tokens bounds
    that of the vectors.
    """
    return fits(tokens, VECTOR_EXTRA)


def in_vocabulary(tokens: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """Drops unknown terms, adds df and both idfs.

    In a large batch, a word of very many questions is looked up without a shuffle.
    """
    if small:
        return terms.join(F.broadcast(tokens), "term")
    tokens = materialise(tokens, "question-tokens")
    asked = tokens.groupBy("term").agg(F.count("*").alias("n_asked"))
    known = materialise(terms.join(asked, "term"), "asked-terms")
    return lookup(tokens, known, ["term"], weight="n_asked").drop("n_asked")


def question_vectors(
    tokens: DataFrame, terms: DataFrame, keys: list[str], small: bool
) -> DataFrame:
    """(keys, term, qtf, df, idf, bm25_idf, qw, q_norm); unknown terms dropped."""
    known = in_vocabulary(tokens, terms, small).withColumn(
        "qw", weights.query_weight(F.col("qtf"), F.col("idf"))
    )
    whole = Window.partitionBy(*keys)
    norm = F.sqrt(F.sum(F.col("qw") * F.col("qw")).over(whole))
    return known.select(
        *keys, "term", "qtf", "df", "idf", "bm25_idf", "qw", norm.alias("q_norm")
    )
