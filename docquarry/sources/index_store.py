"""The index at rest: Parquet tables bucketed by document.

``documents``, ``postings`` and ``norms`` share one bucketing by ``doc_id``, so
scoring a (question, document) pair and joining document data needs no shuffle.
Postings are sorted by term inside a bucket: a filter on a few terms skips most
row groups by their statistics. ``by_term`` holds the postings once more, bucketed by
cell: a term, or a slice of the documents of a frequent term, with the documents' norms. A
single query names its cells, so only their buckets are opened. As this is the only other
copy of the postings that is shuffled, it is written when it is first asked for, unless
the index is to last. ``terms`` is bucketed by
term and sorted, in small row groups: the words of a query are looked up in their buckets.
The other tables are plain Parquet; ``bounds`` has the largest share of each frequent term by length of the documents,
``lexicon`` and ``stopwords`` are what the texts were prepared with, for the questions to come.

A bucketed table is known to the catalog only while it is opened: the DataFrame keeps its
bucketing, so nothing is left behind that someone would have to drop. The files stay until
whoever chose the folder removes it.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.joins import lookup
from docquarry.sources.shared import new_path

BUCKETED = {
    "documents": ("doc_id BIGINT, tokens ARRAY<STRING>, dl BIGINT", "doc_id"),
    "postings": (
        "doc_id BIGINT, term STRING, tf BIGINT, dl BIGINT, positions ARRAY<INT>",
        "term",
    ),
    "norms": ("doc_id BIGINT, l2 DOUBLE", "doc_id"),
    "by_term": (
        "cell BIGINT, term STRING, doc_id BIGINT, tf BIGINT, dl BIGINT, l2 DOUBLE",
        "cell",
    ),
    "terms": ("term STRING, df BIGINT, idf DOUBLE, bm25_idf DOUBLE", "term"),
}
BUCKET_KEY = {"by_term": "cell", "terms": "term"}
ROW_GROUP_BYTES = {"terms": 1 << 20}  # a look-up reads a few row groups of one bucket
AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
SLICE_POSTINGS = 4_000_000  # of one term in one cell
PLAIN = {
    "bounds": "term STRING, class INT, max_tf BIGINT, min_dl BIGINT, max_share DOUBLE",
    "corpus": (
        "n_docs BIGINT, n_nonempty BIGINT, avgdl DOUBLE, buckets INT,"
        " compounds BOOLEAN, stopped BOOLEAN"
    ),
    "lexicon": "t1 STRING, t2 STRING, n BIGINT",
    "stopwords": "term STRING",
}


# Documents per bucket up to which a task may hold the bucket's norms in memory.
HASHED_NORMS = 2_000_000


def in_buckets(norms: DataFrame, n_docs: int, buckets: int) -> DataFrame:
    """Norms for joins inside buckets.

    While a bucket has few enough documents, its norms are hashed, which spares
    sorting the other side; otherwise the join sorts and can spill.
    """
    return norms.hint("shuffle_hash") if n_docs <= HASHED_NORMS * buckets else norms


@dataclass(frozen=True)
class Index:
    documents: DataFrame
    postings: DataFrame
    norms: DataFrame
    terms: DataFrame
    bounds: DataFrame
    corpus: DataFrame
    lexicon: DataFrame
    stopwords: DataFrame
    cells: DataFrame | None  # ``by_term``, if it is written
    path: str
    buckets: int
    n_docs: int
    compounds: bool
    stopped: bool

    @property
    def spark(self) -> SparkSession:
        return self.corpus.sparkSession

    @cached_property
    def by_term(self) -> DataFrame:
        """Postings by cell; written at the first use, to a folder of their own, where the
        index at rest has none."""
        if self.cells is not None:
            return self.cells
        return save_cells(self.postings, self.norms, self.terms, new_path(self.spark, "cells"), self.buckets)

    @property
    def bucket_norms(self) -> DataFrame:
        return in_buckets(self.norms, self.n_docs, self.buckets)

    @property
    def preparation(self) -> dict[str, DataFrame | None]:
        """What its texts were prepared with."""
        return {
            "lexicon": self.lexicon if self.compounds else None,
            "stopwords": self.stopwords if self.stopped else None,
        }

    def scalar(self, name: str):
        """A corpus statistic as a scalar subquery."""
        return self.corpus.select(name).scalar()


def n_slices(df: Column) -> Column:
    """Cells that the postings of a term with this document frequency are spread over."""
    return F.ceil(df / SLICE_POSTINGS)


def cell_of(term: Column, number: Column) -> Column:
    return F.xxhash64(term, number.cast("long"))


def _resolved(spark: SparkSession, name: str) -> DataFrame:
    """The table as a DataFrame of its files, and the name given back."""
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df


def _new_name(table: str) -> str:
    return f"docquarry_{table}_{uuid.uuid4().hex}"


@contextmanager
def whole_buckets(spark: SparkSession):
    """Bucketed tables are scanned a bucket a task, also where no join or grouping asks for
    it. Spark packs their files into tasks of 128 MB then, whose rows, sorted for the next
    table, spill."""
    before = spark.conf.get(AUTO_SCAN)
    spark.conf.set(AUTO_SCAN, "false")
    try:
        yield
    finally:
        spark.conf.set(AUTO_SCAN, before)


def save_bucketed(df: DataFrame, path: str, table: str, buckets: int) -> DataFrame:
    name = _new_name(table)
    writer = (
        df.write.format("parquet")
        .bucketBy(buckets, BUCKET_KEY.get(table, "doc_id"))
        .sortBy(BUCKETED[table][1])
        .option("path", f"{path}/{table}")
        .option("compression", "zstd")
        .options(**{"parquet.block.size": size for name, size in ROW_GROUP_BYTES.items() if name == table})
    )
    with whole_buckets(df.sparkSession):
        writer.saveAsTable(name)
    return _resolved(df.sparkSession, name)


def save_cells(posting_rows: DataFrame, norms: DataFrame, terms: DataFrame, path: str, buckets: int) -> DataFrame:
    """Postings (cell, term, doc_id, tf, dl, l2) by cell, written."""
    sliced = terms.select("term", "df", n_slices(F.col("df")).alias("slices"))
    counts = posting_rows.select("doc_id", "term", "tf", "dl").join(norms, "doc_id")
    placed = lookup(counts, sliced, ["term"], weight="df")
    cell = cell_of(F.col("term"), F.pmod(F.xxhash64("doc_id"), F.col("slices")))
    # the cell, a hash that does not compress, is not shuffled but computed again
    rows = placed.select("term", "doc_id", "tf", "dl", "l2", F.col("slices").cast("int").alias("slices"))
    rows = rows.repartition(buckets, cell).select(cell.alias("cell"), "term", "doc_id", "tf", "dl", "l2")
    return save_bucketed(rows, path, "by_term", buckets)


def save_plain(df: DataFrame, path: str, table: str) -> DataFrame:
    df.write.parquet(f"{path}/{table}")
    return df.sparkSession.read.schema(PLAIN[table]).parquet(f"{path}/{table}")


def save_index(index: Index, path: str) -> Index:
    """Copy an index to another place, whole and keeping its bucketing."""
    kept = {
        table: save_bucketed(getattr(index, table), path, table, index.buckets)
        for table in BUCKETED
        if table != "by_term"
    }
    kept |= {table: save_plain(getattr(index, table), path, table) for table in PLAIN}
    if "by_term" in vars(index) or index.cells is not None:
        cells = save_bucketed(index.by_term, path, "by_term", index.buckets)
    else:
        cells = save_cells(index.postings, index.norms, index.terms, path, index.buckets)
    return replace(index, **kept, cells=cells, path=path)


def open_index(spark: SparkSession, path: str) -> Index:
    """Open a stored index."""
    tables = {t: spark.read.schema(s).parquet(f"{path}/{t}") for t, s in PLAIN.items()}
    stats = tables["corpus"].first()
    try:
        spark.read.parquet(f"{path}/by_term")
        written = True
    except AnalysisException:  # there are none: a table over an absent folder would be empty
        written = False
    for table, (schema, order) in BUCKETED.items():
        if table == "by_term" and not written:
            continue
        name, key = _new_name(table), BUCKET_KEY.get(table, "doc_id")
        location = f"{path}/{table}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet"
            f" CLUSTERED BY ({key}) SORTED BY ({order}) INTO {stats.buckets} BUCKETS"
            f" LOCATION '{location}'"
        )
        tables[table] = _resolved(spark, name)
    return Index(
        **{table: df for table, df in tables.items() if table != "by_term"},
        cells=tables.get("by_term"),
        path=path,
        buckets=stats.buckets,
        n_docs=stats.n_docs,
        compounds=stats.compounds,
        stopped=stats.stopped,
    )
