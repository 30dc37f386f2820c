"""Named queries over a folder with the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.text import nfc, token_string
from docquarry.operators import compounds, corpus, idsets, metrics, postings, profile, sampling
from docquarry.operators.questions import in_vocabulary, question_tokens, vectors_fit
from docquarry.operators.joins import broadcast_if_small, lookup
from docquarry.operators.ranking import candidates, ranked_lists, with_excerpts
from docquarry.plans.evaluation import Evaluation, evaluate, evaluate_ranking, save_evaluation
from docquarry.plans.reduction import reduce_tables
from docquarry.plans.retrieval import rank, retrieve, retrieve_bm25, vectors_of
from docquarry.plans.workspace import KEYS, Workspace, workspace
from docquarry.sources import tables
from docquarry.sources.index_store import open_index, save_index
from docquarry.sources.shared import new_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL uses the same ones.
SAMPLE_ROWS = 500
CUTOFF = 500
LOOKUP_ID = 42

_queries: dict[str, Query] = {}


def query(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    _queries[fn.__name__] = lambda spark, sf_dir: fn(workspace(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


def ids(column: str) -> Column:
    """An id array as text."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def corpus_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.lit("corpus").alias("name"),
        F.col("doc_id").alias("id"),
        F.lit(-1).cast("long").alias("part"),
        F.col("text").alias("content"),
    )


def token_rows(tokens: DataFrame) -> DataFrame:
    rows = corpus.positions(tokens).filter(F.col("token").isNotNull())
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


# --- corpus -----------------------------------------------------------------


@query
def corpus_profile(ws: Workspace) -> DataFrame:
    return profile.profile(ws.table("documents"))


@query
def corpus_describe(ws: Workspace) -> DataFrame:
    stats = profile.describe(ws.table("documents"), ["doc_id", "n_chars"])
    return stats.select("column", "count", r6("mean"), r6("stddev"), "min", "max")


@query
def labels_describe(ws: Workspace) -> DataFrame:
    stats = profile.describe(ws.questions(), ["split", "qid", "question"])
    return stats.select("column", "count", r6("mean"), r6("stddev"), "min", "max")


@query
def corpus_point_lookup(ws: Workspace) -> DataFrame:
    found = profile.lookup_document(ws.table("documents"), LOOKUP_ID)
    return found.select(F.col("doc_id").alias("cid"), "text")


@query
def corpus_sample_limit(ws: Workspace) -> DataFrame:
    return sampling.first_documents(ws.corpus(), SAMPLE_ROWS)


@query
def corpus_sample_cutoff(ws: Workspace) -> DataFrame:
    return sampling.documents_up_to(ws.corpus(), CUTOFF)


@query
def labels_array_cutoff(ws: Workspace) -> DataFrame:
    cut = sampling.labels_up_to(ws.label_lists, CUTOFF)
    return cut.select(*KEYS, "part", "question", ids("cid"))


@query
def labels_bitmap_cutoff(ws: Workspace) -> DataFrame:
    """The same cut on sets of ids: questions that keep an id, and how many."""
    kept = idsets.up_to(idsets.id_blocks(ws.qrels, KEYS), KEYS, CUTOFF)
    return idsets.sizes(kept, KEYS)


@query
def sample_consistent_qrels(ws: Workspace) -> DataFrame:
    sample = sampling.first_documents(ws.corpus(), SAMPLE_ROWS)
    return sampling.judgments_within(ws.qrels, sample).select(*KEYS, "doc_id")


@query
def reduce_tables_roundtrip(ws: Workspace) -> DataFrame:
    base = new_path(ws.spark, "reduced")
    labels = f"{base}/labels"
    tables.write_table(ws.label_lists, labels)
    out = [f"{base}/corpus-cut", f"{base}/labels-cut"]
    source = f"{ws.sf_dir}/documents.parquet"
    reduce_tables(ws.spark, source, [labels], out, CUTOFF)
    docs = tables.read_table(ws.spark, out[0])
    kept = tables.read_table(ws.spark, out[1])
    return corpus_rows(docs).unionAll(kept.select(F.lit("labels"), "qid", "part", ids("cid")))


# --- text -------------------------------------------------------------------


@query
def tokens_clean(ws: Workspace) -> DataFrame:
    return token_rows(corpus.tokenise(corpus.clean(ws.spread_corpus())))


@query
def tokens_nfc(ws: Workspace) -> DataFrame:
    text = nfc(F.coalesce("text", F.lit("")))
    return ws.spread_corpus().select("doc_id", text.alias("text"))


@query
def docs_token_string(ws: Workspace) -> DataFrame:
    documents = postings.with_length(corpus.tokenise(corpus.clean(ws.spread_corpus())))
    return documents.select("doc_id", token_string(F.col("tokens")).alias("content"), "dl")


@query
def tokens_no_stopwords(ws: Workspace) -> DataFrame:
    tokens = ws.index.documents.select("doc_id", "tokens")
    return token_rows(corpus.drop_stopwords(tokens, ws.stopwords))


@query
def lexicon_learn(ws: Workspace) -> DataFrame:
    return ws.pairs_counted()


@query
def stopwords_load(ws: Workspace) -> DataFrame:
    path = new_path(ws.spark, "stopwords")
    single = ws.stopwords.select(F.concat(F.lit("  "), "term", F.lit(" ")))
    phrases = ws.lexicon.select(F.concat_ws(" ", "t1", "t2"))
    blank = single.select(F.lit(" "))
    single.unionAll(phrases).unionAll(blank).unionAll(single).write.text(path)
    return tables.read_stopwords(ws.spark, path)


@query
def tokens_compound(ws: Workspace) -> DataFrame:
    joined = compounds.join_compounds(ws.placed_words, ws.lexicon)
    return token_rows(corpus.keep_valid(joined))


# --- index ------------------------------------------------------------------


@query
def postings_positions(ws: Workspace) -> DataFrame:
    return ws.index.postings.select("doc_id", "term", ids("positions"))


@query
def vocabulary(ws: Workspace) -> DataFrame:
    return postings.vocabulary(ws.index.postings)


@query
def tf(ws: Workspace) -> DataFrame:
    return ws.index.postings.select("doc_id", "term", "tf")


@query
def term_stats(ws: Workspace) -> DataFrame:
    stats = postings.term_stats(ws.index.postings, ws.index.scalar("n_docs"))
    return stats.select("term", "df", r6("idf"), r6("bm25_idf"))


@query
def tfidf_weights(ws: Workspace) -> DataFrame:
    return postings.tfidf(ws.index.postings, ws.index.terms).select("doc_id", "term", r6("w"))


@query
def doc_l2(ws: Workspace) -> DataFrame:
    weighted = postings.tfidf(ws.index.postings, ws.index.terms)
    return postings.document_norms(weighted).select("doc_id", r6("l2"))


@query
def tfidf_normalized(ws: Workspace) -> DataFrame:
    weighted = postings.tfidf(ws.index.postings, ws.index.terms)
    return postings.normalise(weighted, ws.index.bucket_norms).select("doc_id", "term", r6("w_norm"))


@query
def doc_token_counts(ws: Workspace) -> DataFrame:
    counts = postings.token_counts(ws.index.postings)
    joined = ws.index.documents.select("doc_id").join(counts, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("dl", F.lit(0)).alias("dl"))


@query
def corpus_stats(ws: Workspace) -> DataFrame:
    n_terms = ws.index.terms.agg(F.count("*").alias("n")).scalar()
    stats = postings.corpus_stats(ws.index.documents)
    return stats.select("n_docs", "n_nonempty", r6("avgdl"), n_terms.alias("n_terms"))


@query
def index_roundtrip(ws: Workspace) -> DataFrame:
    path = new_path(ws.spark, "copy")
    save_index(ws.index, path)
    again = open_index(ws.spark, path)
    stats = again.terms.select("term", "df", r6("idf"))
    rows = again.postings.select("doc_id", "term", "tf", "dl")
    rows = rows.join(again.norms, "doc_id", "left")
    joined = lookup(rows, stats, ["term"], weight="df")
    return joined.select("doc_id", "term", "tf", "dl", r6("l2"), "idf")


# --- retrieval --------------------------------------------------------------


@query
def query_terms(ws: Workspace) -> DataFrame:
    tokens = question_tokens(ws.questions(), KEYS, **ws.index.preparation)
    known = in_vocabulary(tokens, ws.index.terms, vectors_fit(tokens))
    return known.select(*KEYS, "term", "qtf")


@query
def query_vectors(ws: Workspace) -> DataFrame:
    vectors, _ = vectors_of(ws.index, ws.questions(), KEYS)
    return vectors.select(*KEYS, "term", "qtf", r6("qw"), r6("q_norm"))


@query
def candidate_counts(ws: Workspace) -> DataFrame:
    vectors, small = vectors_of(ws.index, ws.questions(), KEYS)
    found = candidates(ws.index, vectors, KEYS, small)
    return found.groupBy(*KEYS).agg(F.count("*").alias("n_candidates"))


@query
def candidate_documents(ws: Workspace) -> DataFrame:
    vectors, _ = vectors_of(ws.index, ws.questions(), KEYS)
    asked = broadcast_if_small(vectors.select("term").distinct())
    matching = ws.index.postings.join(asked, "term", "left_semi").select("doc_id").distinct()
    return ws.index.documents.select("doc_id", "dl").join(matching, "doc_id", "left_semi")


def first_question(ws: Workspace) -> str:
    return ws.questions().orderBy("qid").first().question


@query
def rank_cosine_one(ws: Workspace) -> DataFrame:
    return retrieve(ws.index, first_question(ws), k=10)


@query
def rank_bm25_one(ws: Workspace) -> DataFrame:
    return retrieve_bm25(ws.index, first_question(ws), k=10)


@query
def rank_cosine_all(ws: Workspace) -> DataFrame:
    return rank(ws.index, ws.questions(), KEYS, methods=("tfidf",)).drop("method")


@query
def rank_bm25_distinct(ws: Workspace) -> DataFrame:
    asked = ws.questions()
    return rank(ws.index, asked, KEYS, methods=("bm25",), query_tf="distinct").drop("method")


@query
def rank_bm25_multiplicity(ws: Workspace) -> DataFrame:
    return rank(ws.index, ws.questions(), KEYS, methods=("bm25",)).drop("method")


@query
def rank_both(ws: Workspace) -> DataFrame:
    return rank(ws.index, ws.questions(), KEYS)


@query
def rank_bounded(ws: Workspace) -> DataFrame:
    """The same ranking, with only those documents scored that can be in it."""
    return rank(ws.index, ws.questions(), KEYS, score_all=0)


@query
def rank_bm25_compound(ws: Workspace) -> DataFrame:
    return rank(ws.compound_index, ws.questions(), KEYS, methods=("bm25",)).drop("method")


@query
def rank_both_stopwords(ws: Workspace) -> DataFrame:
    return rank(ws.stopped_index, ws.questions(), KEYS)


@query
def rank_arrays(ws: Workspace) -> DataFrame:
    keys = ["method", *KEYS]
    return ranked_lists(ws.ranking, keys).select(*keys, ids("retrieved"))


@query
def rank_excerpts(ws: Workspace) -> DataFrame:
    shown = with_excerpts(ws.ranking, ws.index.documents)
    return shown.select("method", *KEYS, "rank", "doc_id", "score", "excerpt")


# --- labels -----------------------------------------------------------------


@query
def qrels(ws: Workspace) -> DataFrame:
    return metrics.prefixed_judgments(ws.qrels)


@query
def qrels_truth_sets(ws: Workspace) -> DataFrame:
    judged, _ = metrics.truth(ws.label_lists, KEYS)
    return judged


@query
def query_lookup(ws: Workspace) -> DataFrame:
    return metrics.query_lookup(ws.questions(), ws.qrels, KEYS)


@query
def contexts_exploded(ws: Workspace) -> DataFrame:
    found = profile.question_contexts(ws.qrels, ws.questions(), ws.contexts, KEYS)
    return found.select("qid", "question", "context")


@query
def contexts_distinct(ws: Workspace) -> DataFrame:
    return ws.contexts.select("context").distinct()


@query
def contexts_dedup(ws: Workspace) -> DataFrame:
    return profile.context_per_id_set(ws.qrels, ws.contexts, KEYS)


@query
def train_test_union(ws: Workspace) -> DataFrame:
    counted = ws.questions().join(ws.judged(), KEYS, "left")
    rows = counted.select(*KEYS, "question", F.coalesce("n_relevant", F.lit(0)).alias("n_relevant"))
    train = rows.filter(F.col("split") == "train")
    return train.union(rows.filter(F.col("split") == "test"))


# --- evaluation -------------------------------------------------------------


def evaluation(ws: Workspace) -> Evaluation:
    return evaluate_ranking(ws.ranking, ws.questions(), ws.judged(), ws.qrels, KEYS)


@query
def metrics_per_query(ws: Workspace) -> DataFrame:
    names = [r6(c) for c in metrics.metric_names()]
    return evaluation(ws).per_question.select("method", *KEYS, *names)


@query
def metrics_summary(ws: Workspace) -> DataFrame:
    means = metrics.summary(evaluation(ws).per_question)
    return means.select("method", "num_queries", *[r6(c) for c in metrics.metric_names()])


def _long(summary: DataFrame) -> DataFrame:
    values = "mrr", "map", "precision", "recall", "ndcg"
    return summary.select(
        "method", "num_queries", F.col("k").cast("int").alias("k"), *[r6(c) for c in values]
    )


@query
def metrics_long(ws: Workspace) -> DataFrame:
    return _long(evaluate(ws.index, ws.label_lists, KEYS).summary)


@query
def summary_csv_roundtrip(ws: Workspace) -> DataFrame:
    path = new_path(ws.spark, "summary")
    tables.write_summary(evaluation(ws).summary, path, fmt="csv")
    schema = (
        "method STRING, num_queries BIGINT, mrr DOUBLE, map DOUBLE, k INT,"
        " precision DOUBLE, recall DOUBLE, ndcg DOUBLE"
    )
    return _long(ws.spark.read.schema(schema).option("header", True).csv(path))


@query
def results_json_roundtrip(ws: Workspace) -> DataFrame:
    path = new_path(ws.spark, "evaluation")
    save_evaluation(evaluation(ws), path)
    stored = tables.read_records(ws.spark, f"{path}/records")
    values = [
        F.round(F.col("metrics")[name.replace("_", "@")], 6).alias(name)
        for name in metrics.metric_names()
    ]
    return stored.select("method", *KEYS, "query", *values, ids("retrieved"))


@query
def export_json_roundtrip(ws: Workspace) -> DataFrame:
    base = new_path(ws.spark, "export")
    tables.export_corpus_json(ws.corpus(), f"{base}/corpus")
    test = ws.label_lists.filter(F.col("split") == "test")
    tables.export_questions_json(test, f"{base}/questions")
    docs = ws.spark.read.schema(tables.CORPUS_SCHEMA).json(f"{base}/corpus")
    asked = ws.spark.read.schema(tables.LABELS_SCHEMA).json(f"{base}/questions")
    content = F.concat_ws("|", "question", ids("cid"))
    return corpus_rows(docs).unionAll(asked.select(F.lit("questions"), "qid", "part", content))
