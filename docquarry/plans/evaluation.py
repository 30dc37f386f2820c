"""Evaluation of both ranking models over labelled questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docquarry.functions.fixed import K_VALUES
from docquarry.operators import metrics as m
from docquarry.operators.ranking import METHODS, ranked_lists
from docquarry.plans.retrieval import rank
from docquarry.sources.index_store import Index
from docquarry.sources.shared import materialise
from docquarry.sources.tables import write_records, write_summary


@dataclass(frozen=True)
class Evaluation:
    per_question: DataFrame
    records: DataFrame
    summary: DataFrame


def evaluate_ranking(
    ranking: DataFrame,
    questions: DataFrame,
    judged: DataFrame,
    qrels: DataFrame,
    keys: list[str],
    ks: tuple[int, ...] = K_VALUES,
) -> Evaluation:
    """Metrics of a ranking; questions it does not contain are not counted."""
    per_question = m.question_metrics(m.hits(ranking, judged, qrels, keys), keys, ks)
    lists = ranked_lists(ranking, ["method", *keys])
    return Evaluation(
        per_question,
        m.records(per_question, lists, questions, keys, ks),
        m.summary_long(m.summary(per_question, ks), ks),
    )


def evaluate(
    index: Index,
    labels: DataFrame,
    keys: list[str],
    methods: tuple[str, ...] = METHODS,
    ks: tuple[int, ...] = K_VALUES,
) -> Evaluation:
    """Rank all judged questions of ``labels(keys, question, cid)`` and measure.

    ``keys`` must tell apart the sets that were united (a split and an id): a
    question present in two of them counts twice.
    """
    judged, qrels = m.truth(labels, keys)
    questions = labels.groupBy(*keys).agg({"question": "min"})
    questions = questions.withColumnRenamed("min(question)", "question")
    asked = questions.join(judged.select(*keys), keys, "left_semi")
    ranking = materialise(rank(index, asked, keys, max(ks), methods), "ranking")
    return evaluate_ranking(ranking, asked, judged, qrels, keys, ks)


def save_evaluation(result: Evaluation, path: str) -> None:
    write_records(result.records, f"{path}/records")
    write_summary(result.summary, f"{path}/summary")
