"""Metrics, judgments, sampling, and the stored results."""

import json
import random
from pathlib import Path

import pytest

from conftest import tuples
from docquarry.operators import metrics, profile, sampling
from docquarry.plans.evaluation import evaluate, evaluate_ranking, save_evaluation
from docquarry.plans.indexing import build_index
from docquarry.plans.reduction import reduce_tables
from docquarry.operators import containment
from docquarry.sources import tables
from docquarry.sources.shared import new_path, shared_dir

LABELS = "split string, qid long, question string, cid array<long>"
KEYS = ["split", "qid"]


def ranking(spark, *lists):
    rows = [
        ("bm25", "test", qid, rank, doc_id, 1.0)
        for qid, ids in enumerate(lists)
        for rank, doc_id in enumerate(ids, 1)
    ]
    return spark.createDataFrame(
        rows, "method string, split string, qid long, rank int, doc_id long, score double"
    )


def measured(spark, rows, labels, ks=(1, 5, 10)):
    frame = spark.createDataFrame([("test", *label) for label in labels], LABELS)
    judged, qrels = metrics.truth(frame, KEYS)
    return evaluate_ranking(rows, frame, judged, qrels, KEYS, ks)


def test_metric_example(spark):
    result = measured(spark, ranking(spark, [7, 3, 9, 1, 5]), [(0, "q", [3, 5, 8, 3])])
    row = result.per_question.first()
    want = {
        "p_5": 0.4, "r_5": 0.666667, "mrr": 0.5, "map": 0.3, "ndcg_5": 0.477624,
        "ndcg_1": 0.0, "p_1": 0.0, "p_10": 0.2, "r_10": 0.666667,
    }
    assert {name: round(row[name], 6) for name in want} == want


def plain_metrics(ids, truth, k):
    import math

    found = [i for i, doc in enumerate(ids[:k]) if doc in truth]
    dcg = sum(1 / math.log2(i + 2) for i in found)
    best = sum(1 / math.log2(i + 2) for i in range(min(len(truth), k)))
    return len(found) / k, len(found) / len(truth), dcg / best


def test_metrics_against_plain_formulas(spark):
    rng = random.Random(5)
    lists = [rng.sample(range(30), rng.randint(1, 10)) for _ in range(40)]
    truths = [rng.sample(range(30), rng.randint(1, 15)) for _ in lists]
    labels = [(i, "q", truth) for i, truth in enumerate(truths)]
    rows = measured(spark, ranking(spark, *lists), labels).per_question.collect()
    assert len(rows) == 40
    for row in rows:
        for k in (1, 5, 10):
            got = row[f"p_{k}"], row[f"r_{k}"], row[f"ndcg_{k}"]
            assert got == pytest.approx(plain_metrics(lists[row.qid], truths[row.qid], k))
        assert row.r_1 <= row.r_5 <= row.r_10 and row.ndcg_10 <= 1 + 1e-12


def test_questions_without_truth_or_result(spark):
    labels = [
        (0, "null truth", None),
        (1, "empty truth", []),
        (2, "never ranked", [1]),
        (3, "hit", [4]),
    ]
    result = measured(spark, ranking(spark, [4], [4], [], [4]), labels)
    rows = {r.qid: r for r in result.per_question.collect()}
    assert set(rows) == {1, 3}
    assert all(rows[1][name] == 0 for name in metrics.metric_names())
    assert rows[3].mrr == rows[3].r_1 == rows[3].ndcg_10 == 1 and rows[3].p_10 == 0.1
    summary = {r.k: r for r in result.summary.collect()}
    assert summary[1].num_queries == 2 and summary[1].mrr == 0.5
    assert summary[10].precision == pytest.approx(0.05)


def test_rank_cut_before_metrics_and_k_zero(spark):
    result = measured(spark, ranking(spark, [9, 8, 1]), [(0, "q", [1])], ks=(0, 2))
    row = result.per_question.first()
    assert (row.mrr, row.map, row.p_0, row.r_0, row.ndcg_0, row.r_2) == (0, 0, 0, 0, 0, 0)


def test_scalar_truth(spark):
    labels = spark.createDataFrame(
        [("test", 0, "q", 5), ("test", 1, "q", None)], "split string, qid long, question string, cid long"
    )
    judged, qrels = metrics.truth(labels, KEYS)
    assert tuples(judged) == [("test", 0, 1)]
    assert tuples(qrels) == [("test", 0, 5, 1)]


@pytest.fixture(scope="module")
def small_index(spark):
    texts = ["red apple pie", "green apple", "red car", "blue sky"]
    return build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_evaluate_and_store(spark, small_index):
    labels = spark.createDataFrame(
        [
            ("train", 1, "apple pie", [0]),
            ("test", 1, "apple pie", [0, 2]),
            ("test", 2, "unknown words", [1]),
            ("test", 3, "sky", None),
            ("test", 4, "sky", []),
        ],
        LABELS,
    )
    result = evaluate(small_index, labels, KEYS)
    per = {(r.method, r.split, r.qid): r for r in result.per_question.collect()}
    assert {key[1:] for key in per} == {("train", 1), ("test", 1), ("test", 4)}
    assert per["bm25", "train", 1].r_1 == 1 and per["bm25", "test", 1].r_1 == 0.5
    path = new_path(spark, "evaluation")
    save_evaluation(result, path)
    stored = tables.read_records(spark, f"{path}/records").collect()
    assert len(stored) == 6
    record = next(r for r in stored if (r.method, r.split, r.qid) == ("bm25", "train", 1))
    assert record.query == "apple pie" and list(record.retrieved) == [0, 1]
    names = {f"{m}@{k}" for m in ("p", "r", "ndcg") for k in (1, 5, 10)}
    assert set(record.metrics) == {"mrr", "map"} | names
    files = list(Path(path, "records", "method=bm25").glob("*.json"))
    line = json.loads(files[0].read_text(encoding="utf-8").splitlines()[0])
    assert {"split", "qid", "query", "metrics", "retrieved"} == set(line)
    summary = spark.read.json(f"{path}/summary")
    assert summary.count() == 6


def test_summary_of_nothing_is_empty(spark):
    assert measured(spark, ranking(spark, [1]), [(0, "q", None)]).summary.isEmpty()


def test_sampling(spark):
    labels = spark.createDataFrame(
        [(1, [3, 12]), (2, [11]), (3, [10]), (4, None), (5, [])], "qid long, cid array<long>"
    )
    assert tuples(sampling.labels_up_to(labels, 10)) == [(1, [3]), (3, [10])]
    docs = spark.createDataFrame([(i, str(i)) for i in (5, 1, 30, 7)], "doc_id long, text string")
    assert tuples(sampling.first_documents(docs, 2)) == [(1, "1"), (5, "5")]
    assert sampling.first_documents(docs, 10).count() == 4
    assert tuples(sampling.documents_up_to(docs, 7), "doc_id") == [(1,), (5,), (7,)]
    qrels = spark.createDataFrame([(1, 5), (1, 30)], "qid long, doc_id long")
    kept = sampling.judgments_within(qrels, sampling.first_documents(docs, 3))
    assert tuples(kept, "qid", "doc_id") == [(1, 5)]


@pytest.mark.parametrize("by,kept", [("id", [1, 2]), ("rows", [1, 2, 9])])
def test_reduce_tables(spark, by, kept):
    base = new_path(spark, "reduce")
    docs = spark.createDataFrame([(i, "t") for i in (1, 2, 9)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(1, "q", [1, 9]), (2, "q", [9])], "qid long, question string, cid array<long>"
    )
    tables.write_table(docs, f"{base}/docs")
    tables.write_table(labels, f"{base}/train")
    out = [f"{base}/docs-cut", f"{base}/train-cut"]
    reduce_tables(spark, f"{base}/docs", [f"{base}/train"], out, 3, by)
    assert [r.doc_id for r in spark.read.parquet(out[0]).orderBy("doc_id").collect()] == kept
    assert tuples(spark.read.parquet(out[1])) == [(1, "q", [1])]
    with pytest.raises(ValueError):
        reduce_tables(spark, f"{base}/docs", [f"{base}/train"], [f"{base}/docs", out[1]], 3)


def test_judgment_ids_and_lookup(spark):
    questions = spark.createDataFrame(
        [("a", 1, "one"), ("b", 1, "uno"), ("a", 2, "two"), ("a", 3, "three")],
        "split string, qid long, question string",
    )
    qrels = spark.createDataFrame(
        [("a", 1, 4), ("b", 1, 4), ("a", 1, 5), ("a", 3, 5)], "split string, qid long, doc_id long"
    )
    pairs = [("q1", "c4", 1), ("q1", "c5", 1), ("q3", "c5", 1)]
    assert tuples(metrics.prefixed_judgments(qrels)) == pairs
    # a question without a judgment is not listed
    assert tuples(metrics.query_lookup(questions, qrels, KEYS)) == [("q1", "one"), ("q3", "three")]


def test_profile_and_describe(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, None)], "doc_id long, text string")
    assert tuples(profile.profile(docs)) == [(4, 3, 3)]  # null is a value
    assert tuples(profile.profile(docs.filter("doc_id = 2"))) == [(2, 1, 2)]
    assert tuples(profile.profile(docs.limit(0))) == [(0, 0, 0)]
    assert tuples(profile.describe(docs, ["doc_id", "text"])) == [
        ("doc_id", 4, 2.0, 0.816497, "1", "3"),
        ("text", 3, None, None, "a", "b"),
    ]


def test_contexts(spark):
    qrels = spark.createDataFrame(
        [("a", 1, 4), ("a", 1, 5), ("b", 1, 5), ("b", 1, 4), ("a", 2, 5)],
        "split string, qid long, doc_id long",
    )
    contexts = spark.createDataFrame([(4, "x"), (5, "w")], "doc_id long, context string")
    questions = spark.createDataFrame(
        [("a", 1, "q"), ("b", 1, "r"), ("a", 2, "s")], "split string, qid long, question string"
    )
    assert tuples(profile.context_per_id_set(qrels, contexts, KEYS)) == [(1, 5, "w"), (2, 4, "w")]
    assert profile.question_contexts(qrels, questions, contexts, KEYS).count() == 5


def test_exports_and_summary_csv(spark, small_index):
    base = new_path(spark, "export")
    docs = spark.createDataFrame([(1, "kế toán"), (2, None)], "doc_id long, text string")
    tables.export_corpus_json(docs, f"{base}/docs")
    assert tuples(spark.read.schema(tables.CORPUS_SCHEMA).json(f"{base}/docs")) == [(1, "kế toán"), (2, None)]
    summary = measured(spark, ranking(spark, [4]), [(0, "q", [4])]).summary
    tables.write_summary(summary, f"{base}/summary", fmt="csv")
    assert spark.read.option("header", True).csv(f"{base}/summary").count() == 3


def test_read_table_checks_columns(spark):
    path = new_path(spark, "narrow")
    tables.write_table(spark.range(3), path)
    with pytest.raises(ValueError, match="text"):
        tables.read_table(spark, path, tables.CORPUS_SCHEMA)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_containment_against_brute_force(spark, setting, limit):
    rng = random.Random(11)
    words = ["a", "b", "ab", "", "c.d", "é😀", "longer"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(80)] + [None]
    passages = ["", " ", None, "never there at all", "zz"]
    while len(passages) < 60:
        text = rng.choice(texts[:-1])
        start = rng.randint(0, max(0, len(text) - 12))
        passages.append(text[start : start + rng.randint(1, 14)])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(
        [("test", i, p) for i, p in enumerate(passages)], "split string, qid long, question string"
    )
    want = [
        ("test", i, d)
        for i, p in enumerate(passages)
        for d, text in enumerate(texts)
        if p is not None and text is not None and p in text
    ]
    with setting("docquarry.broadcastBytes", limit):
        assert tuples(containment.containing(asked, docs, KEYS)) == sorted(want, key=repr)
        assert containment.containing(asked.filter("question IS NULL"), docs, KEYS).isEmpty()


@pytest.mark.parametrize("named, bits", [(200, 1 << 23), (0, 64)])
def test_only_marked_runs_become_rows(spark, monkeypatch, named, bits):
    monkeypatch.setattr(containment, "NAMED", named)
    monkeypatch.setattr(containment, "MOST_BITS", bits)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["(a", "b)+", "[", "\\d", "é"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 80))) for _ in range(200)] + [None, "", " ", "w1  w2"]
    asked = ["", " ", "(a", ")+ [", "\\d", "w1 w2", "1 w2 w", None, "none of these words at all", "é"]
    for text in rng.sample(texts[:200], 12):
        start = rng.randrange(max(1, len(text)))
        asked.append(text[start : start + rng.randrange(1, 60)])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    passages = spark.createDataFrame([("s", i, q) for i, q in enumerate(asked)], "split string, qid long, question string")
    hits, plain = [], containment.materialise

    def watched(df, label):
        rows = plain(df, label)
        hits.extend([rows.count()] if label == "run-hits" else [])
        return rows

    monkeypatch.setattr(containment, "materialise", watched)
    got = tuples(containment.containing(passages, docs, KEYS))
    want = [("s", i, d) for i, q in enumerate(asked) for d, t in enumerate(texts) if q is not None and t is not None and q in t]
    assert got == sorted(want, key=repr)
    if named:  # far fewer rows than runs, even with five sizes of short passages
        long = passages.filter("length(question) > 30")
        hits.clear()
        containment.containing(long, docs, KEYS).count()
        assert hits[0] < 0.05 * sum(len((t or "").split(" ")) for t in texts)


def test_nth_id_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SORTED_IDS", 20)
    monkeypatch.setattr(sampling, "SKETCH", 50)
    rng = random.Random(9)
    ids = rng.sample(range(-500, 10**12), 1500) + list(range(500))
    docs = spark.createDataFrame([(i, "t") for i in {*ids}] + [(None, "t")], "doc_id long, text string")
    known = sorted({*ids})
    for n in (1, 2, 499, 1000, len(known) - 1, len(known), 5000):
        assert sampling.nth_smallest(docs, n) == known[min(n, len(known)) - 1]
    assert sampling.first_documents(docs, 700).count() == 700
    assert sampling.first_documents(docs, 0).isEmpty() and sampling.first_documents(docs.limit(0), 3).isEmpty()


def test_profile_multiplies_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "doc_id long, text string")
    found = profile.profile(docs)
    assert tuples(found) == [(3, 2, 2)]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
