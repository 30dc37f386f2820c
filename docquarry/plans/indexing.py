"""Index build: one shuffle of the texts, then everything by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators import postings as ops
from docquarry.operators.compounds import token_arrays, token_arrays_of
from docquarry.operators.corpus import clean, one_row_per_id
from docquarry.sources.index_store import Index, in_buckets, save_bucketed, save_cells, save_plain
from docquarry.sources.shared import new_path

BUCKET_SETTING = "docquarry.bucketBytes"
DEFAULT_BUCKET_BYTES = 16 * 1024**2  # what a task sorts and adds up of a bucket stays in its memory


def bucket_count(spark: SparkSession, text_bytes: int) -> int:
    """Enough buckets to use all cores and to keep each near 16 MiB of text."""
    cores = spark.sparkContext.defaultParallelism
    most = int(spark.conf.get(BUCKET_SETTING, str(DEFAULT_BUCKET_BYTES)))
    return max(cores, -(-text_bytes // most))


def measure_texts(docs: DataFrame, unique_ids: bool) -> tuple[int, bool]:
    """Bytes of text, and whether an id is repeated, in one pass."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    if unique_ids:
        return docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first().b, False
    by_id = docs.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(size).alias("b"))
    row = by_id.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.max("n").alias("n")).first()
    return row.b, (row.n or 0) > 1


def prepare_documents(
    docs: DataFrame,
    buckets: int,
    lexicon: DataFrame | None = None,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """Token arrays, one row per document, partitioned by document."""
    placed = clean(docs).repartition(buckets, "doc_id")
    return ops.with_length(token_arrays(placed, lexicon, stopwords))


def build_index(
    docs: DataFrame,
    path: str | None = None,
    buckets: int | None = None,
    lexicon: DataFrame | None = None,
    stopwords: DataFrame | None = None,
    unique_ids: bool = False,
    words: DataFrame | None = None,
) -> Index:
    """Build and store all index tables of ``docs(doc_id, text)``.

    Each table is written once and the next one is derived from what was
    written, so nothing is tokenised twice and a lost executor costs its tasks. An index
    of the caller's ``path`` is whole; one in the shared folder gets its postings by cell,
    which not every use needs, when they are first asked for.
    ``unique_ids`` vouches for one row per document and skips the check. The bucket
    count follows from the texts' size unless ``buckets`` sets it. ``words``, if at hand, are
    all words of the cleaned texts, a written table in as many buckets.
    """
    spark = docs.sparkSession
    lasting, path = path is not None, path or new_path(spark, "index")
    size, repeated = measure_texts(docs, unique_ids)
    buckets = buckets or bucket_count(spark, size)
    if repeated:
        docs = one_row_per_id(docs)
    given = {
        "lexicon": lexicon if lexicon is not None else spark.createDataFrame([], "t1 string, t2 string, n long"),
        "stopwords": stopwords if stopwords is not None else spark.createDataFrame([], "term string"),
    }
    kept = {name: save_plain(df, path, name) for name, df in given.items()}
    used = {
        "lexicon": kept["lexicon"] if lexicon is not None else None,
        "stopwords": kept["stopwords"] if stopwords is not None else None,
    }

    def store(df: DataFrame, table: str) -> DataFrame:
        return save_bucketed(df, path, table, buckets)

    made = prepare_documents(docs, buckets, **used) if words is None else ops.with_length(token_arrays_of(words, **used))
    documents = store(made, "documents")
    stats = ops.corpus_stats(documents).withColumns(
        {
            "buckets": F.lit(buckets),
            "compounds": F.lit(lexicon is not None),
            "stopped": F.lit(stopwords is not None),
        }
    )
    corpus = save_plain(stats, path, "corpus")
    posting_rows = store(ops.postings(documents), "postings")
    counts = posting_rows.select("doc_id", "term", "tf", "dl")
    n_docs = corpus.select("n_docs").scalar()
    terms = store(ops.term_stats(counts, n_docs).repartition(buckets, "term"), "terms")
    norms = store(ops.document_norms(ops.tfidf(counts, terms)), "norms")
    found = corpus.first().n_docs
    limits = ops.bounds(counts, in_buckets(norms, found, buckets), terms, found).sortWithinPartitions("term")
    return Index(
        documents,
        posting_rows,
        norms,
        terms,
        save_plain(limits, path, "bounds"),
        corpus,
        **kept,
        cells=save_cells(posting_rows, norms, terms, path, buckets) if lasting else None,
        path=path,
        buckets=buckets,
        n_docs=found,
        compounds=lexicon is not None,
        stopped=stopwords is not None,
    )
