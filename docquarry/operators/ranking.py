"""Scoring and ranking of documents for whole tables of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import weights
from docquarry.functions.fixed import (
    BM25_B,
    BM25_K1,
    EXCERPT_LENGTH,
    EXCERPT_SUFFIX,
    METHOD_BM25,
    METHOD_TFIDF,
    MISSING_TEXT,
    SCORE_DIGITS,
)
from docquarry.functions.text import token_string
from docquarry.operators.joins import broadcast_if_small, broadcast_limit, measure, slice_rows
from docquarry.sources.index_store import Index, cell_of, n_slices
from docquarry.sources.shared import materialise

METHODS = (METHOD_TFIDF, METHOD_BM25)


def matches(index: Index, vectors: DataFrame, keys: list[str], small: bool, columns: tuple[str, ...]) -> DataFrame:
    """Postings of the question terms, one row per (question, term, document), with
    ``columns`` of the postings.

    Small question sets are broadcast: postings stay where they are, bucketed by
    document. Otherwise the questions' terms are dealt out to the cells of ``by_term``, and
    postings are joined in the buckets where they lie; they bring their norms along.
    """
    if small:
        return index.postings.select(*columns).join(F.broadcast(vectors), "term")
    vectors = materialise(vectors, "vectors")
    size = slice_rows(index.spark)
    heavy = _heavy(vectors, size)
    rows, used = measure(heavy)
    while used > broadcast_limit(index.spark):  # larger slices until the list of sliced terms is small
        size *= 2
        heavy = _heavy(vectors, size)
        rows, used = measure(heavy)
    columns = (*columns, "l2")
    light = vectors.join(F.broadcast(heavy.select("term")), "term", "left_anti") if rows else vectors
    found = _by_cell(index.by_term.select("cell", *columns), light)
    if rows:
        found = found.unionByName(_by_slices(index.by_term.select(*columns), vectors, F.broadcast(heavy), keys))
    return found


def _by_cell(postings: DataFrame, vectors: DataFrame) -> DataFrame:
    """Postings by cell joined with vectors. The cell alone is the key, as that is what the
    postings are bucketed by; terms are compared besides, should two share a cell."""
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), n_slices(F.col("df")) - 1))
    asked = vectors.withColumn("i", numbers).withColumn("cell", cell_of(F.col("term"), F.col("i"))).drop("i")
    asked = asked.withColumnRenamed("term", "asked")
    same = F.startswith("term", "asked") & F.startswith("asked", "term")
    joined = postings.join(asked, (postings["cell"] == asked["cell"]) & same)
    return joined.drop("cell", "asked")


def _by_slices(postings: DataFrame, vectors: DataFrame, heavy: DataFrame, keys: list[str]) -> DataFrame:
    """Postings of terms of very many questions: a grid of documents in slices and
    questions in slices, and every pair of slices is dealt out on its own."""

    def dealt(rows: DataFrame, own: str, other: str, *ids: str) -> DataFrame:
        """Rows in their own slice, once for every slice of the other side."""
        placed = rows.join(heavy, "term").withColumns(
            {
                own: F.pmod(F.xxhash64(*ids), f"n_{own}").cast("int"),
                other: F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)),
            }
        )
        return placed.drop("n_docs", "n_questions")

    left = dealt(postings, "docs", "questions", "doc_id")
    right = dealt(vectors, "questions", "docs", *keys)
    return left.join(right, ["term", "docs", "questions"]).drop("docs", "questions")


def _heavy(vectors: DataFrame, size: int) -> DataFrame:
    """Terms of more than ``size`` questions, and the slices of both sides."""
    asked = vectors.groupBy("term").agg(F.max("df").alias("df"), F.count("*").alias("n"))
    above = asked.filter(F.col("n") > size)
    slices = lambda c: F.ceil(F.col(c) / size).cast("int")
    return above.select("term", slices("df").alias("n_docs"), slices("n").alias("n_questions"))


def candidates(index: Index, vectors: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """(keys, doc_id): documents with any term of the question."""
    return matches(index, vectors, keys, small, ("doc_id", "term")).select(*keys, "doc_id").distinct()


def score(
    index: Index,
    vectors: DataFrame,
    keys: list[str],
    small: bool,
    methods: tuple[str, ...] = METHODS,
    query_tf: str = "multiplicity",
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> DataFrame:
    """(method, keys, doc_id, score) of every matching document.

    Both models come from one pass over the postings. ``query_tf`` says whether
    BM25 adds a term once per occurrence in the question (``multiplicity``) or
    once (``distinct``). Postings that carry norms are not joined with them.
    """
    carried = ("doc_id", "term", "tf", "dl", *(["l2"] if "l2" in index.postings.columns else []))
    hits = matches(index, vectors, keys, small, carried)
    return scores_of(sums(index, hits, keys, small, methods, query_tf, k1, b), keys, methods)


def sums(
    index: Index,
    hits: DataFrame,
    keys: list[str],
    small: bool,
    methods: tuple[str, ...],
    query_tf: str,
    k1: float,
    b: float,
    *extra: Column,
) -> DataFrame:
    """(keys, doc_id, one column per method) of rows of question terms in documents;
    ``extra`` are further aggregates. A tfidf of zero stands for none."""
    if query_tf not in ("multiplicity", "distinct"):
        raise ValueError(f"unknown query_tf {query_tf!r}")
    with_norms = "l2" in hits.columns
    bm25 = weights.bm25_weight(
        F.col("tf"), F.col("dl"), index.scalar("avgdl"), F.col("bm25_idf"), k1, b
    )
    if query_tf == "multiplicity":
        bm25 = bm25 * F.col("qtf")
    wanted = {
        METHOD_BM25: [F.sum(bm25).alias(METHOD_BM25)],
        METHOD_TFIDF: [
            F.sum(F.col("qw") * F.col("tf") * F.col("idf")).alias("dot"),
            F.max("q_norm").alias("q_norm"),
        ],
    }
    if with_norms:
        wanted[METHOD_TFIDF].append(F.max("l2").alias("l2"))
    columns = [column for method in methods for column in wanted[method]]
    summed = hits.groupBy(*keys, "doc_id").agg(*columns, *extra)
    if METHOD_TFIDF in methods:
        if not with_norms:
            norms = index.bucket_norms if small else index.norms
            summed = summed.join(norms, "doc_id", "left")
        length = F.col("q_norm") * F.coalesce("l2", F.lit(1.0))
        summed = summed.withColumn(METHOD_TFIDF, F.col("dot") / length).drop("dot", "q_norm", "l2")
    return summed


def scores_of(summed: DataFrame, keys: list[str], methods: tuple[str, ...]) -> DataFrame:
    """(method, keys, doc_id, score) of sums, one row per method."""
    pairs = [F.struct(F.lit(m).alias("method"), F.col(m).alias("score")) for m in methods]
    rows = summed.select(*keys, "doc_id", F.explode(F.array(*pairs)).alias("r"))
    positive = (F.col("r.score") > 0) | (F.col("r.method") != METHOD_TFIDF)
    return rows.filter(positive).select(
        "r.method", *keys, "doc_id", F.round("r.score", SCORE_DIGITS).alias("score")
    )


def top_k(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Best k documents per group, ties by id; cut per task before the shuffle."""
    best_first = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    ranked = scores.withColumn("rank", F.row_number().over(best_first))
    return ranked.filter(F.col("rank") <= k)


def top_k_single(scores: DataFrame, k: int) -> DataFrame:
    """Best k rows of one question's scores."""
    best = scores.orderBy(F.desc("score"), "doc_id").limit(k)
    order = Window.orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order))


def ranked_lists(ranking: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, retrieved): the document ids of each ranking, best first."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "doc_id")))
    return ranking.groupBy(*keys).agg(entries.getField("doc_id").alias("retrieved"))


def head(text: Column) -> Column:
    return F.substring(text, 1, EXCERPT_LENGTH)


def with_excerpts(ranking: DataFrame, documents: DataFrame) -> DataFrame:
    """Adds the start of each document's cleaned text.

    ``ranking`` is read twice and should be a written table. Its ids select the
    documents first, so that no other text is joined or shuffled.
    """
    ids = broadcast_if_small(ranking.select("doc_id").distinct())
    heads = documents.join(ids, "doc_id", "left_semi").select(
        "doc_id", head(token_string(F.col("tokens"))).alias("head")
    )
    shown = F.coalesce("head", head(F.lit(MISSING_TEXT)))
    return (
        ranking.join(heads, "doc_id", "left")
        .withColumn("excerpt", F.concat(shown, F.lit(EXCERPT_SUFFIX)))
        .drop("head")
    )
