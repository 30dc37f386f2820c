"""Relevance judgments and ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.fixed import K_VALUES
from docquarry.functions.weights import discounted_gain, ideal_gain


def truth(labels: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Judged questions (keys, n_relevant) and judgments (keys, doc_id, rel).

    ``cid`` may hold one id or an array of ids; a question without ``cid`` is not
    judged, one with an empty list is judged and has no relevant document.
    """
    listed = labels
    if not isinstance(labels.schema["cid"].dataType, T.ArrayType):
        one = F.when(F.col("cid").isNotNull(), F.array("cid"))
        listed = labels.withColumn("cid", one)
    listed = listed.filter(F.col("cid").isNotNull())
    pairs = listed.select(*keys, F.explode_outer("cid").alias("doc_id")).distinct()
    judged = pairs.groupBy(*keys).agg(F.count("doc_id").alias("n_relevant"))
    return judged, pairs.filter(F.col("doc_id").isNotNull()).withColumn("rel", F.lit(1))


def judged_questions(qrels: DataFrame, keys: list[str]) -> DataFrame:
    return qrels.groupBy(*keys).agg(F.count("*").alias("n_relevant"))


def prefixed_judgments(qrels: DataFrame) -> DataFrame:
    """(query_id, corpus_id, rel) of (qid, doc_id), with ids written as q<qid> and c<id>."""
    return qrels.select(
        F.concat(F.lit("q"), F.col("qid")).alias("query_id"),
        F.concat(F.lit("c"), F.col("doc_id")).alias("corpus_id"),
        F.lit(1).alias("rel"),
    ).distinct()


def query_lookup(questions: DataFrame, qrels: DataFrame, keys: list[str]) -> DataFrame:
    """(query_id, question), one row per qid of a question with a judgment."""
    judged = questions.join(qrels.select(*keys).distinct(), keys, "left_semi")
    one = judged.groupBy("qid").agg(F.min("question").alias("question"))
    return one.select(F.concat(F.lit("q"), F.col("qid")).alias("query_id"), "question")


def hits(
    ranking: DataFrame, judged: DataFrame, qrels: DataFrame, keys: list[str]
) -> DataFrame:
    """Ranked documents of judged questions with a 0/1 ``hit``."""
    relevant = qrels.select(*keys, "doc_id", F.lit(1).alias("found"))
    return (
        ranking.join(judged, keys)
        .join(relevant, [*keys, "doc_id"], "left")
        .withColumn("hit", F.coalesce("found", F.lit(0)))
        .drop("found")
    )


def question_metrics(
    hit_rows: DataFrame, keys: list[str], ks: tuple[int, ...] = K_VALUES
) -> DataFrame:
    """One row per method and question, from rankings cut at ``max(ks)``.

    Precision divides by k however few were retrieved; average precision divides
    by the number of relevant documents.
    """
    group = ["method", *keys]
    by_rank = Window.partitionBy(*group).orderBy("rank")
    so_far = by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank, hit = F.col("rank"), F.col("hit")
    rows = hit_rows.filter(rank <= max(ks)).withColumn(
        "precision", F.sum("hit").over(so_far) / rank
    )
    sums = [
        F.coalesce(F.max(F.when(hit == 1, 1 / rank)), F.lit(0.0)).alias("mrr"),
        F.sum(F.when(hit == 1, F.col("precision")).otherwise(0.0)).alias("ap"),
    ]
    for k in ks:
        inside = (rank <= k) & (hit == 1)
        sums += [
            F.count(F.when(inside, hit)).alias(f"hits_{k}"),
            F.sum(F.when(inside, discounted_gain(rank)).otherwise(0.0)).alias(f"dcg_{k}"),
        ]
    totals = rows.groupBy(*group, "n_relevant").agg(*sums)
    n = F.col("n_relevant")
    columns = [F.col("mrr"), _share(F.col("ap"), n).alias("map")]
    for k in ks:
        found = F.col(f"hits_{k}")
        columns += [
            (found / k if k else F.lit(0.0)).alias(f"p_{k}"),
            _share(found, n).alias(f"r_{k}"),
            _share(F.col(f"dcg_{k}"), ideal_gain(n, k)).alias(f"ndcg_{k}"),
        ]
    return totals.select(*group, *columns)


def _share(part, whole):
    return F.when(whole > 0, part / whole).otherwise(0.0)


def metric_names(ks: tuple[int, ...] = K_VALUES) -> list[str]:
    return ["mrr", "map"] + [f"{m}_{k}" for k in ks for m in ("p", "r", "ndcg")]


def summary(per_question: DataFrame, ks: tuple[int, ...] = K_VALUES) -> DataFrame:
    """Means over the evaluated questions of each method, and their number."""
    means = [F.avg(name).alias(name) for name in metric_names(ks)]
    return per_question.groupBy("method").agg(F.count("*").alias("num_queries"), *means)


def summary_long(means: DataFrame, ks: tuple[int, ...] = K_VALUES) -> DataFrame:
    """(method, num_queries, mrr, map, k, precision, recall, ndcg)."""
    rows = [
        F.struct(
            F.lit(k).alias("k"),
            F.col(f"p_{k}").alias("precision"),
            F.col(f"r_{k}").alias("recall"),
            F.col(f"ndcg_{k}").alias("ndcg"),
        )
        for k in ks
    ]
    kept = "method", "num_queries", "mrr", "map"
    return means.select(*kept, F.inline(F.array(*rows)))


def records(
    per_question: DataFrame,
    lists: DataFrame,
    questions: DataFrame,
    keys: list[str],
    ks: tuple[int, ...] = K_VALUES,
) -> DataFrame:
    """(method, keys, query, metrics, retrieved): the stored result of a question."""
    entries = []
    for name in metric_names(ks):
        entries += [F.lit(name.replace("_", "@")), F.col(name)]
    texts = questions.select(*keys, F.col("question").alias("query"))
    return (
        per_question.join(lists, ["method", *keys])
        .join(texts, keys)
        .select("method", *keys, "query", F.create_map(*entries).alias("metrics"), "retrieved")
    )
