"""The roles of a retrieval task, filled from the given tables.

corpus <- documents; questions <- the benchmark passages, whole; relevant documents <-
those that contain the passage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.text import is_kept
from docquarry.operators.compounds import learn_lexicon
from docquarry.operators.containment import containing, documents_of
from docquarry.operators.corpus import (
    clean,
    frequent_terms,
    has_duplicate_ids,
    one_row_per_id,
    words,
)
from docquarry.operators.joins import broadcast_if_small
from docquarry.operators.metrics import judged_questions
from docquarry.operators.postings import document_frequency_of
from docquarry.plans.indexing import bucket_count, build_index, measure_texts
from docquarry.plans.retrieval import rank
from docquarry.sources.index_store import Index, save_bucketed, whole_buckets
from docquarry.sources.shared import materialise, new_path
from docquarry.sources.tables import CORPUS_SCHEMA, read_table, spread

KEYS = ["split", "qid"]
LEXICON_COUNT = 100
STOPWORD_SHARE = 0.4

# Ids a label list holds at most. The relevant documents of a question come in parts, one
# per block of ids; the part is a key of the list, so no list passes for a whole question.
LABEL_BLOCK = 256


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, input_bytes: int = 0):
        self.spark = spark
        self.sf_dir = sf_dir
        self.input_bytes = input_bytes

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _corpus(self) -> DataFrame:
        docs = read_table(self.spark, f"{self.sf_dir}/documents.parquet", CORPUS_SCHEMA)
        if has_duplicate_ids(docs):
            return materialise(one_row_per_id(docs), "corpus")
        return docs

    def corpus(self) -> DataFrame:
        """(doc_id, text), one row per id."""
        return self._corpus

    def pairs_counted(self) -> DataFrame:
        """(t1, t2, n) of frequent pairs of words; tasks of the first count are bounded."""
        with whole_buckets(self.spark):
            return learn_lexicon(self.placed_words, LEXICON_COUNT, slots=self.buckets)

    def spread_corpus(self) -> DataFrame:
        return spread(self.corpus(), self.input_bytes, "doc_id")

    def placed_corpus(self) -> DataFrame:
        """Cleaned texts, partitioned by document as in an index."""
        return clean(self.corpus()).repartition(self.buckets, "doc_id")

    @cached_property
    def buckets(self) -> int:
        return bucket_count(self.spark, measure_texts(self.corpus(), unique_ids=True)[0])

    @cached_property
    def placed_words(self) -> DataFrame:
        """(doc_id, tokens): all words of the cleaned texts, as a written table bucketed as
        an index is. The lexicon, the stopwords and the indexes with compounds read it."""
        placed = words(self.placed_corpus())
        return save_bucketed(placed, new_path(self.spark, "words"), "documents", self.buckets)

    def questions(self) -> DataFrame:
        """(split, qid, question): the whole passages."""
        even = F.col("item_id") % 2 == 0
        return self.table("benchmark").select(
            F.when(even, "train").otherwise("test").alias("split"),
            F.col("item_id").alias("qid"),
            F.col("text").alias("question"),
        )

    @cached_property
    def qrels(self) -> DataFrame:
        """(split, qid, doc_id) as a written table."""
        return materialise(containing(self.questions(), self.spread_corpus(), KEYS), "qrels")

    def judged(self) -> DataFrame:
        return judged_questions(self.qrels, KEYS)

    @cached_property
    def contexts(self) -> DataFrame:
        """(doc_id, context) of all judged documents, as a written table."""
        found = documents_of(self.qrels, self.corpus())
        return materialise(found.withColumnRenamed("text", "context"), "contexts")

    @cached_property
    def label_lists(self) -> DataFrame:
        """(split, qid, part, question, cid) as a written table: the relevant ids of a
        question in parts of at most ``LABEL_BLOCK`` ids, for what works on arrays."""
        part = F.floor(F.col("doc_id") / LABEL_BLOCK).alias("part")
        lists = self.qrels.groupBy(*KEYS, part).agg(
            F.sort_array(F.collect_list("doc_id")).alias("cid")
        )
        joined = lists.join(broadcast_if_small(self.questions()), KEYS)
        return materialise(joined.select(*KEYS, "part", "question", "cid"), "label-lists")

    @cached_property
    def index(self) -> Index:
        return build_index(self.corpus(), unique_ids=True)

    @cached_property
    def stopwords(self) -> DataFrame:
        """(term) as a written table: terms of more than a share of the documents."""
        if "index" in vars(self):
            terms, n_docs = self.index.terms, self.index.scalar("n_docs")
        else:  # the words that are frequent are known without an index
            at_hand = "placed_words" in vars(self)
            found = self.placed_words if at_hand else words(clean(self.spread_corpus()))
            terms = document_frequency_of(found).filter(is_kept(F.col("term")))
            n_docs = self.corpus().count()
        return materialise(frequent_terms(terms, n_docs, STOPWORD_SHARE), "stopwords")

    @cached_property
    def compound_index(self) -> Index:
        return build_index(self.corpus(), unique_ids=True, lexicon=self.lexicon, **self._words)

    @cached_property
    def stopped_index(self) -> Index:
        return build_index(
            self.corpus(), unique_ids=True, lexicon=self.lexicon, stopwords=self.stopwords, **self._words
        )

    @property
    def _words(self) -> dict:
        return {"words": self.placed_words, "buckets": self.buckets}

    @cached_property
    def lexicon(self) -> DataFrame:
        """(t1, t2, n) as a written table."""
        return materialise(self.pairs_counted(), "lexicon")

    @cached_property
    def ranking(self) -> DataFrame:
        """Both models, all questions, as a written table."""
        return materialise(rank(self.index, self.questions(), KEYS), "ranking")


_open: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """One workspace per session and state of the input files.

    Files are compared by path, length and time; their contents are not read.
    """
    paths = [f"{sf_dir}/{name}.parquet" for name in ("documents", "benchmark")]
    files = spark.read.format("binaryFile").load(paths)
    state = files.agg(
        F.sum("length").alias("size"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash"),
    ).first()
    key = (spark.sparkContext.applicationId, sf_dir, state.size, state.hash)
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir, state.size)
    return _open[key]
