"""The bounded ranking against the ranking of all matches."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from docquarry.operators import postings, topk
from docquarry.plans.indexing import build_index
from docquarry.plans.retrieval import rank
from docquarry.plans.workspace import KEYS, workspace

COLUMNS = ["method", "split", "qid", "rank", "doc_id", "score"]


@pytest.fixture(scope="module")
def many(spark):
    """Documents of very unlike lengths, many of them equal, over common and rare words."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=int(1.4 ** rng.randrange(2, 20)))) for _ in range(150)]
    texts += rng.choices(texts, k=250) + ["", None, "w1 w1", "w59"]
    few, postings.FEW_POSTINGS = postings.FEW_POSTINGS, 5
    try:
        yield build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    finally:
        postings.FEW_POSTINGS = few


@pytest.fixture(scope="module")
def questions(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["unknown"]
    rows = [("s" if i % 3 else None, i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(25)]
    rows += [("s", 90, None), ("s", 91, "unknown"), (None, None, "w1 w2"), ("s", 92, " ".join(words) * 2)]
    return spark.createDataFrame(rows, "split string, qid long, question string")


@pytest.mark.parametrize("limit", [64 << 20, 3_000, 0])
def test_rows_are_the_same(many, questions, setting, limit):
    with setting("docquarry.broadcastBytes", limit), setting("docquarry.sliceRows", 50 if limit < 64 << 20 else 10**6):
        want = tuples(rank(many, questions, KEYS, score_all=10**15), *COLUMNS)
        assert tuples(rank(many, questions, KEYS, score_all=0), *COLUMNS) == want and len(want) > 300


@pytest.mark.parametrize(
    "how",
    [
        {"k": 1, "methods": ("bm25",)},
        {"k": 3, "methods": ("tfidf",)},
        {"k": 25, "query_tf": "distinct", "k1": 0.4, "b": 1.0},
        {"k": 500, "k1": 2.0, "b": 0.0},
    ],
)
def test_rows_are_the_same_with_other_parameters(many, questions, how):
    want = tuples(rank(many, questions, KEYS, score_all=10**15, **how), *COLUMNS)
    assert tuples(rank(many, questions, KEYS, score_all=0, **how), *COLUMNS) == want


def test_bounds_hold_for_every_posting(many):
    rows = many.postings.join(many.norms, "doc_id").withColumn("class", postings.length_class(F.col("dl")))
    held = rows.join(many.bounds, ["term", "class"])
    beyond = (F.col("tf") > F.col("max_tf")) | (F.col("dl") < F.col("min_dl")) | (F.col("tf") / F.col("l2") > F.col("max_share"))
    assert held.filter(beyond).isEmpty() and held.count() > 500
    common = rows.groupBy("term").count().filter("count > 5").select("term")
    assert rows.join(common, "term", "left_semi").count() == held.count()


def test_few_documents_are_scored(spark, monkeypatch):
    ws = workspace(spark, "/root/testdata/sf0.01")
    scored, plain = [], topk.Bounded.scored

    def counting(self, pairs):
        rows = plain(self, pairs)
        scored.append(rows.count())
        return rows

    monkeypatch.setattr(topk.Bounded, "scored", counting)
    got = tuples(rank(ws.index, ws.questions(), KEYS, score_all=0), *COLUMNS)
    assert got == tuples(rank(ws.index, ws.questions(), KEYS), *COLUMNS)
    from docquarry.operators.ranking import score
    from docquarry.plans.retrieval import vectors_of

    vectors, small = vectors_of(ws.index, ws.questions(), KEYS)
    every = score(ws.index, vectors, KEYS, small).count()
    assert sum(scored) < every / 5, (scored, every)
