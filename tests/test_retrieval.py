"""Index, statistics and rankings on hand-computed values."""

import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, tuples
from docquarry.operators import blocks, postings, ranking
from docquarry.operators.compounds import join_compounds
from docquarry.operators.corpus import clean, drop_stopwords, words
from docquarry.operators.joins import lookup
from docquarry.operators.questions import question_tokens, question_vectors
from docquarry.plans import indexing
from docquarry.plans import workspace as workspace_plan
from docquarry.plans.indexing import bucket_count, build_index, prepare_documents
from docquarry.plans.retrieval import rank, retrieve, retrieve_bm25, vectors_of
from docquarry.plans.workspace import KEYS, Workspace, workspace
from docquarry.registry import queries
from docquarry.sources import index_store
from docquarry.sources.index_store import open_index, save_index
from docquarry.sources.shared import new_path

TOY = [
    (1, "kế_toán trưởng công_ty"),
    (2, "kế_toán kế_toán thuế"),
    (3, "công_ty cổ_phần công_ty thuế"),
    (4, "? !"),
]


@pytest.fixture(scope="module")
def toy(spark):
    docs = spark.createDataFrame(TOY + [(2, "zz kế_toán")], "doc_id long, text string")
    return build_index(docs)


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, question string")


def test_index_tables(toy):
    assert tuples(toy.postings) == sorted(
        [
            (1, "công_ty", 1, 3, [2]),
            (1, "kế_toán", 1, 3, [0]),
            (1, "trưởng", 1, 3, [1]),
            (2, "kế_toán", 2, 3, [0, 1]),
            (2, "thuế", 1, 3, [2]),
            (3, "công_ty", 2, 4, [0, 2]),
            (3, "cổ_phần", 1, 4, [1]),
            (3, "thuế", 1, 4, [3]),
        ],
        key=repr,
    )
    assert tuples(toy.terms) == sorted(
        [
            ("kế_toán", 2, 1.221849, 0.693147),
            ("công_ty", 2, 1.221849, 0.693147),
            ("thuế", 2, 1.221849, 0.693147),
            ("trưởng", 1, 1.39794, 1.203973),
            ("cổ_phần", 1, 1.39794, 1.203973),
        ],
        key=repr,
    )
    assert tuples(toy.norms) == [(1, 2.222626), (2, 2.732137), (3, 3.069008)]
    assert tuples(toy.corpus, "n_docs", "n_nonempty", "avgdl") == [(4, 3, 3.333333)]


def test_weights_are_unit_length(toy):
    weighted = postings.tfidf(toy.postings, toy.terms)
    normal = postings.normalise(weighted, toy.norms)
    lengths = normal.groupBy("doc_id").agg(F.sum(F.col("w_norm") ** 2).alias("l"))
    assert all(abs(r.l - 1) < 1e-12 for r in lengths.collect())


def test_missing_statistics_use_defaults(spark, toy):
    terms = toy.terms.filter(F.col("term") != "thuế")
    weighted = postings.tfidf(toy.postings, terms)
    assert tuples(weighted.filter("term = 'thuế'"), "doc_id", "w") == [(2, 0.0), (3, 0.0)]
    normal = postings.normalise(weighted, toy.norms.filter("doc_id != 1"))
    one = tuples(normal.filter("doc_id = 1 AND term = 'trưởng'"), "w", "w_norm")
    assert one == [(1.39794, 1.39794)]


COSINE = [
    (0, 1, 1, 0.777439), (0, 2, 2, 0.632456), (0, 3, 3, 0.563034),
    (1, 1, 2, 0.981688), (1, 2, 1, 0.435859), (1, 3, 3, 0.24262),
]
DISTINCT = [
    (0, 1, 1, 1.445425), (0, 2, 2, 0.980658), (0, 3, 3, 0.902322),
    (1, 1, 2, 1.703371), (1, 2, 1, 0.722713), (1, 3, 3, 0.640724),
]
REPEATED = DISTINCT[:3] + [(1, 1, 2, 2.684029), (1, 2, 1, 1.445425), (1, 3, 3, 0.640724)]


@pytest.mark.parametrize("limit,rows", [(64 << 20, 1_000_000), (400, 1), (0, 1_000_000)])
def test_rankings(spark, toy, setting, limit, rows):
    questions = ask(spark, "kế_toán công_ty", "Kế_toán kế_toán thuế xyz", "xyz")
    with setting("docquarry.broadcastBytes", limit), setting("docquarry.sliceRows", rows):
        both = rank(toy, questions, ["qid"]).cache()
        distinct = rank(toy, questions, ["qid"], methods=("bm25",), query_tf="distinct")
        columns = ["qid", "rank", "doc_id", "score"]
        assert tuples(both.filter("method = 'tfidf'"), *columns) == COSINE
        assert tuples(both.filter("method = 'bm25'"), *columns) == REPEATED
        assert tuples(distinct, *columns) == DISTINCT
    with pytest.raises(ValueError):
        rank(toy, questions, ["qid"], query_tf="twice")


def test_single_queries(toy):
    query = "kế_toán kế_toán thuế xyz"
    assert tuples(retrieve(toy, query, k=2)) == [row[1:] for row in COSINE[3:5]]
    assert tuples(retrieve_bm25(toy, query)) == [row[1:] for row in DISTINCT[3:]]
    assert retrieve(toy, "xyz").isEmpty()
    assert retrieve_bm25(toy, "").isEmpty()
    idf = math.log((4 - 2 + 0.5) / 2.5 + 1)
    flat = tuples(retrieve_bm25(toy, "thuế", k1=1.0, b=0.0), "score")
    assert flat == [(round(idf * 2 / 2, 6),)] * 2


def test_ties_are_ranked_by_id(spark):
    docs = spark.createDataFrame([(i, "same text") for i in (9, 3, 7, 5)], "doc_id long, text string")
    top = rank(build_index(docs), ask(spark, "text"), ["qid"], k=3, methods=("bm25",))
    assert tuples(top, "rank", "doc_id") == [(1, 3), (2, 5), (3, 7)]


def test_empty_corpus(spark):
    index = build_index(spark.createDataFrame([], "doc_id long, text string"))
    assert tuples(index.corpus, "n_docs", "n_nonempty", "avgdl") == [(0, 0, 0.0)]
    assert rank(index, ask(spark, "text"), ["qid"]).isEmpty()


def test_compounds_and_stopwords_in_the_index(spark):
    docs = spark.createDataFrame([(1, "a công ty b các công ty"), (2, "ç")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("công", "ty", 2)], "t1 string, t2 string, n long")
    stop = spark.createDataFrame([("các",)], "term string")
    index = build_index(docs, lexicon=lexicon, stopwords=stop)
    assert tuples(index.postings) == [(1, "công_ty", 2, 2, [0, 1])]
    assert tuples(index.corpus, "n_docs", "n_nonempty") == [(2, 1)]


def test_excerpts(spark, toy):
    wide = spark.createDataFrame([(7, "word " * 40)], "doc_id long, text string")
    documents = build_index(wide).documents
    rows = spark.createDataFrame([(1, 7), (2, 8)], "rank int, doc_id long")
    got = tuples(ranking.with_excerpts(rows, documents), "rank", "excerpt")
    assert got == [(1, ("word " * 20) + "..."), (2, "No content available...")]


def test_ranked_lists(spark):
    rows = spark.createDataFrame([(1, 2, 50), (1, 1, 60), (1, 3, 40)], "qid long, rank int, doc_id long")
    assert tuples(ranking.ranked_lists(rows, ["qid"])) == [(1, [60, 50, 40])]


def test_stored_index_is_the_same(spark, toy):
    path = new_path(spark, "toy")
    save_index(toy, path)
    again = open_index(spark, path)
    for table in ("documents", "postings", "norms", "terms", "corpus"):
        assert tuples(getattr(again, table)) == tuples(getattr(toy, table))
    query = ask(spark, "kế_toán công_ty")
    assert tuples(rank(again, query, ["qid"])) == tuples(rank(toy, query, ["qid"]))
    assert tuples(retrieve(again, "công_ty")) == tuples(retrieve(toy, "công_ty"))


def test_no_tables_are_left_in_the_catalog(spark, toy):
    before = len(spark.catalog.listTables())
    path = new_path(spark, "it's a copy")
    save_index(toy, path)
    assert open_index(spark, path).postings.count() == toy.postings.count()
    assert len(spark.catalog.listTables()) == before


def test_postings_by_cell_are_written_when_they_are_needed(spark, monkeypatch):
    """Not for rankings of all questions and candidates, whichever way; for one question, and
    in an index that is to last."""
    docs = spark.createDataFrame([(i, f"common w{i % 7} w{i}") for i in range(90)], "doc_id long, text string")
    written, save = [], index_store.save_bucketed
    monkeypatch.setattr(index_store, "save_bucketed", lambda *a: written.append(a[1:3]) or save(*a))
    index = build_index(docs)
    asked = ask(spark, "common w3", "w1 w50")
    for score_all in (0, 10**15):
        assert rank(index, asked, ["qid"], k=3, score_all=score_all).count() == 12
    vectors, small = vectors_of(index, asked, ["qid"])
    assert ranking.candidates(index, vectors, ["qid"], small).count() == 103
    assert not written and index.cells is None
    again = open_index(spark, index.path)
    want = tuples(retrieve_bm25(index, "w1 common"))
    assert tuples(retrieve_bm25(index, "w1 common")) == want == tuples(retrieve_bm25(again, "w1 common"))
    assert [table for _, table in written] == ["by_term"] * 2  # each index once, in folders of their own
    assert len(set(written)) == 2
    path = new_path(spark, "lasting")
    lasting = build_index(docs, path)
    whole = tuples(index.by_term)
    for kept in (lasting, save_index(open_index(spark, index.path), new_path(spark, "copy"))):
        opened = open_index(spark, kept.path)
        assert opened.cells is not None and tuples(opened.by_term) == whole


def test_a_bucket_is_written_by_a_task_of_its_own(spark):
    """Not packed into a few large tasks, whose sorts spill."""
    docs = spark.createDataFrame([(i, f"common w{i % 7} w{i}") for i in range(90)], "doc_id long, text string")
    index = build_index(docs, buckets=16)
    copy = save_index(index, new_path(spark, "copy"))
    for table in (index.postings, copy.documents, copy.postings, copy.by_term):
        tasks = [re.search(r"part-(\d+)", name).group(1) for name in table.inputFiles()]
        assert len(set(tasks)) == len(tasks) >= 12
    assert spark.conf.get(index_store.AUTO_SCAN) == "true"


def test_bounds_take_no_shuffle_of_postings(spark):
    """Only the largest shares of each bucket are shuffled."""
    docs = spark.createDataFrame([(i, "common words " * 9) for i in range(200)], "doc_id long, text string")
    index = build_index(docs)
    found = postings.bounds(index.postings, index.norms, index.terms, index.n_docs)
    assert len(exchanges(found)) == 1
    assert {r.term for r in found.collect()} == {"common", "words"}


def test_questions_are_prepared_like_the_index(spark):
    texts = ["new york city hall", "old york town", "new shoes"]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    lexicon = spark.createDataFrame([("new", "york", 2)], "t1 string, t2 string, n long")
    stop = spark.createDataFrame([("town",), (None,)], "term string")
    index = build_index(docs, lexicon=lexicon, stopwords=stop)
    for asked in (index, open_index(spark, index.path)):
        assert tuples(retrieve_bm25(asked, "New York"), "doc_id") == [(1,)]
        assert retrieve(asked, "town").isEmpty()
        found = rank(asked, ask(spark, "new york town", "old york"), ["qid"], methods=("bm25",))
        assert tuples(found, "qid", "doc_id") == [(0, 1), (1, 2)]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_stopwords_with_nulls_whatever_the_size(spark, setting, limit):
    docs = spark.createDataFrame([(1, ["new", "york"]), (2, ["new"]), (3, [])], "doc_id long, tokens array<string>")
    listed = spark.createDataFrame([("new",), (None,), ("new",)], "term string")
    with setting("docquarry.broadcastBytes", limit):
        assert tuples(drop_stopwords(docs, listed)) == [(1, ["york"]), (2, []), (3, [])]
        none = listed.filter("term IS NULL")
        assert tuples(drop_stopwords(docs, none)) == [(1, ["new", "york"]), (2, ["new"]), (3, [])]


def test_buckets_follow_the_texts(spark, setting):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(50)], "doc_id long, text string")
    assert build_index(docs).buckets == spark.sparkContext.defaultParallelism
    with setting("docquarry.bucketBytes", 500):
        assert build_index(docs).buckets == 10


def test_buckets_stay_small(spark):
    """A bucket is sorted and added up in the memory of a task, however large the corpus."""
    assert bucket_count(spark, 0) == spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 10**10) >= 10**10 // (32 << 20)


def test_postings_are_cut_from_sorted_arrays(spark):
    docs = [(1, "b a b a a".split()), (2, []), (3, ["z"]), (None, ["q", "q"])]
    made = spark.createDataFrame(docs, "doc_id long, tokens array<string>").withColumn("dl", F.size("tokens").cast("long"))
    rows = postings.postings(made)
    assert tuples(rows) == sorted(
        [(1, "a", 3, 5, [1, 3, 4]), (1, "b", 2, 5, [0, 2]), (3, "z", 1, 1, [0]), (None, "q", 2, 2, [0, 1])], key=repr
    )
    assert "Aggregate" not in plan_of(rows) and rows.schema["positions"].dataType.simpleString() == "array<int>"


def test_postings_come_in_the_order_of_terms(spark, monkeypatch):
    """The sort of a bucket by term has little left to do; no lambda runs for each token."""
    docs = [(i, [f"t{(i * 7 + j * 3) % 11}" for j in range(20)]) for i in range(30)]
    made = spark.createDataFrame(docs, "doc_id long, tokens array<string>").withColumn("dl", F.size("tokens").cast("long"))
    rows = postings.postings(made.coalesce(1))
    terms = [r.term for r in rows.select("term").collect()]
    assert terms == sorted(terms) and "lambda" not in plan_of(rows)
    want = tuples(rows)
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 50)
    assert tuples(postings.postings(made)) == want


def test_words_are_made_once(spark, monkeypatch):
    """For the lexicon, the stopwords and the index that drops them."""
    made, ws = [], Workspace(spark, SMALL)
    with monkeypatch.context() as patched:
        patched.setattr(workspace_plan, "words", lambda cleaned: made.append(1) or words(cleaned))
        patched.setattr(indexing, "prepare_documents", None)
        got = ws.stopped_index
    want = build_index(ws.corpus(), lexicon=ws.lexicon, stopwords=ws.stopwords)
    assert made == [1] and got.buckets == want.buckets
    for table in ("documents", "postings", "terms", "bounds"):
        assert tuples(getattr(got, table)) == tuples(getattr(want, table))


def test_document_frequency_of_arrays(spark):
    docs = [(1, ["a", "b", "a"]), (2, None), (3, []), (None, ["b", None]), (1, ["b"])]
    made = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    assert tuples(postings.document_frequency_of(made)) == [("a", 1), ("b", 3)]


def test_stopwords_and_compounds_need_no_index(spark):
    ws = Workspace(spark, SMALL)
    queries.tokens_compound(ws), ws.stopwords
    assert "index" not in vars(ws)
    alone, _ = tuples(ws.stopwords), ws.index
    del ws.stopwords
    assert tuples(ws.stopwords) == alone and len(alone) > 5


def test_build_shuffles_texts_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    plan = exchanges(prepare_documents(docs, 5))
    assert len(plan) == 1 and "doc_id" in plan[0]


def test_single_query_opens_its_buckets_only(spark, toy):
    plan = plan_of(retrieve_bm25(toy, "thuế"))
    assert f"SelectedBucketsCount: 1 out of {toy.buckets}" in plan


def test_query_words_are_looked_up_in_their_buckets(spark):
    docs = spark.createDataFrame([(i, f"w{i} w{i + 1} common") for i in range(400)], "doc_id long, text string")
    index = build_index(docs, buckets=16)
    scan = index.terms.filter(F.col("term").isin("w7", "w300", "common"))
    assert scan.count() == 3
    read = scan._jdf.queryExecution().executedPlan()
    scan.collect()
    assert len(index.terms.inputFiles()) == 16
    assert _leaf(read).metrics().apply("numOutputRows").value() < 0.4 * index.terms.count()


def _leaf(plan):
    while plan.children().size():
        plan = plan.children().head()
    return plan


def test_large_batches_leave_postings_where_they_are(spark, setting):
    ws = workspace(spark, SMALL)
    want = tuples(rank(ws.index, ws.questions(), KEYS))
    with setting("docquarry.broadcastBytes", 0), setting("spark.sql.autoBroadcastJoinThreshold", -1):
        vectors = question_vectors(question_tokens(ws.questions(), KEYS), ws.index.terms, KEYS, False)
        hits = ranking.matches(ws.index, vectors, KEYS, False, ("doc_id", "term", "tf", "dl"))
        moved = exchanges(hits)
        assert "SortMergeJoin" in plan_of(hits) and len(moved) == 1 and "cell" in moved[0]
        assert tuples(rank(ws.index, ws.questions(), KEYS)) == want


def test_hot_words_on_both_sides(spark, setting):
    docs = spark.createDataFrame([(i, f"hot w{i % 3}") for i in range(40)], "doc_id long, text string")
    index = build_index(docs)
    questions = ask(spark, *[f"hot w{i % 3}" for i in range(30)])
    want = tuples(rank(index, questions, ["qid"]))
    with setting("docquarry.broadcastBytes", 300), setting("docquarry.sliceRows", 7):
        assert tuples(rank(index, questions, ["qid"])) == want


def test_compounds_with_a_large_lexicon(spark, setting):
    texts = ["a b a b c", "b a", "", None, "c a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = spark.createDataFrame([("a", "b", 3), ("b", "c", 1)], "t1 string, t2 string, n long")
    want = tuples(join_compounds(words(clean(docs)), lexicon))
    with setting("docquarry.broadcastBytes", 0):
        joined = join_compounds(words(clean(docs)), lexicon)
        assert "ArrowEvalPython" not in plan_of(joined)
        assert tuples(joined) == want


def test_large_buckets_are_not_hashed(spark, toy, monkeypatch):
    question = ask(spark, "kế_toán công_ty")
    want = tuples(rank(toy, question, ["qid"]))
    assert "ShuffledHashJoin" in plan_of(rank(toy, question, ["qid"]))
    monkeypatch.setattr(index_store, "HASHED_NORMS", 0)
    assert "ShuffledHashJoin" not in plan_of(rank(toy, question, ["qid"]))
    assert tuples(rank(toy, question, ["qid"])) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line]


def test_scoring_shuffles_no_postings(spark):
    ws = workspace(spark, SMALL)
    plan = exchanges(rank(ws.index, ws.questions(), KEYS))
    # question tokens, question norms, and the best k per task
    assert len(plan) == 3
    assert not any("doc_id" in line.split("plan_id")[0] for line in plan)
    assert not exchanges(postings.document_norms(postings.tfidf(ws.index.postings, ws.index.terms)))


@pytest.mark.parametrize("limit", [64 << 20, 2_000, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_paths_agree(spark, setting, limit, how):
    keys = [None] * 3 + ["hot"] * 500 + [f"k{i % 40}" for i in range(200)] + ["absent"]
    facts = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    weights = {"hot": 500} | {f"k{i}": 5 for i in range(40)}
    dim = spark.createDataFrame(list(weights.items()), "k string, n long")
    with setting("docquarry.broadcastBytes", limit):
        got = {r.id: r.n for r in lookup(facts, dim, ["k"], "n", how).collect()}
    want = {i: weights.get(k) for i, k in enumerate(keys) if how == "left" or k in weights}
    assert got == want


def test_index_invariants(spark):
    index = workspace(spark, SMALL).index
    n = index.corpus.first()
    totals = index.postings.groupBy("doc_id").agg(F.sum("tf").alias("s"), F.max("dl").alias("dl"))
    assert totals.filter("s != dl").isEmpty()
    assert index.postings.filter(F.size("positions") != F.col("tf")).isEmpty()
    assert index.terms.filter((F.col("df") > n.n_docs) | (F.col("idf") < 1)).isEmpty()
    assert index.documents.count() == n.n_docs == 200
    ranked = workspace(spark, SMALL).ranking
    assert ranked.filter("method = 'tfidf' AND (score <= 0 OR score > 1.000001)").isEmpty()
