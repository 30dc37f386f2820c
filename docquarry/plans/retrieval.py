"""Ranking jobs: a table of questions, or one question."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.fixed import BM25_B, BM25_K1, K_VALUES, METHOD_BM25, METHOD_TFIDF
from docquarry.functions.text import literal_tokens
from docquarry.operators import questions as q
from docquarry.operators import ranking as r
from docquarry.operators.joins import broadcast_limit, measure
from docquarry.operators.topk import best
from docquarry.sources.index_store import Index, cell_of, n_slices

SCORE_ALL_SETTING = "docquarry.scoreAll"
DEFAULT_SCORE_ALL = 1_000_000_000


def vectors_of(index: Index, questions: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """Question vectors and whether they are small enough to broadcast."""
    tokens = q.question_tokens(questions, keys, **index.preparation)
    small = q.vectors_fit(tokens)
    return q.question_vectors(tokens, index.terms, keys, small), small


def rank(
    index: Index,
    questions: DataFrame,
    keys: list[str],
    k: int = max(K_VALUES),
    methods: tuple[str, ...] = r.METHODS,
    query_tf: str = "multiplicity",
    k1: float = BM25_K1,
    b: float = BM25_B,
    score_all: int | None = None,
) -> DataFrame:
    """(method, keys, rank, doc_id, score) of the best k documents per question.

    A batch with at most ``score_all`` question terms times documents (given by
    ``docquarry.scoreAll``, if not here) has all its matches scored in one job; a larger
    one only those that can be among the best k. The rows are the same.
    """
    tokens = q.question_tokens(questions, keys, **index.preparation)
    rows, size = measure(tokens, q.VECTOR_EXTRA)
    small = size <= broadcast_limit(index.spark)
    vectors = q.question_vectors(tokens, index.terms, keys, small)
    if score_all is None:
        score_all = int(index.spark.conf.get(SCORE_ALL_SETTING, str(DEFAULT_SCORE_ALL)))
    if rows * index.n_docs > score_all:
        return best(index, vectors, keys, small, k, methods, query_tf, k1, b)
    scores = r.score(index, vectors, keys, small, methods, query_tf, k1, b)
    top = r.top_k(scores, ["method", *keys], k)
    return top.select("method", *keys, "rank", "doc_id", "score")


def _query_terms(index: Index, query: str) -> dict[str, int]:
    """The words of one query, prepared like the index's texts."""
    spark = index.spark
    if not (index.compounds or index.stopped):
        return dict(Counter(spark.range(1).select(literal_tokens(query)).first()[0]))
    one = spark.createDataFrame([(0, query)], "qid long, question string")
    return {r.term: r.qtf for r in q.question_tokens(one, ["qid"], **index.preparation).collect()}


def _retrieve(index: Index, query: str, method: str, k: int, **bm25) -> DataFrame:
    spark = index.spark
    counts = _query_terms(index, query)
    tokens = spark.createDataFrame(
        [(0, term, qtf) for term, qtf in counts.items()], "qid long, term string, qtf long"
    )
    # the terms of one query are few: they are looked up in their buckets of the
    # vocabulary, and the postings are read from the buckets of their cells
    wanted = F.col("term").isin(list(counts))
    known = index.terms.filter(wanted)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), n_slices(F.col("df")) - 1))
    cells = known.select("term", numbers.alias("i")).select(cell_of(F.col("term"), F.col("i")).alias("c"))
    opened = F.col("cell").isin([row.c for row in cells.collect()])
    vectors = q.question_vectors(tokens, known, ["qid"], small=True)
    narrowed = replace(index, postings=index.by_term.filter(opened & wanted))
    scores = r.score(narrowed, vectors, ["qid"], True, (method,), **bm25)
    return r.top_k_single(scores, k).select("rank", "doc_id", "score")


def retrieve(index: Index, query: str, k: int = 10) -> DataFrame:
    """Best k documents for one query string by TF-IDF cosine."""
    return _retrieve(index, query, METHOD_TFIDF, k)


def retrieve_bm25(
    index: Index, query: str, k: int = 10, k1: float = BM25_K1, b: float = BM25_B
) -> DataFrame:
    """Best k documents for one query string by BM25, each distinct term once."""
    return _retrieve(index, query, METHOD_BM25, k, query_tf="distinct", k1=k1, b=b)
