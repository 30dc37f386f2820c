"""Inverted index tables and the statistics derived from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions import weights
from docquarry.operators.blocks import token_blocks
from docquarry.operators.joins import lookup


def with_length(tokens: DataFrame) -> DataFrame:
    """Document table of the index: adds the token count."""
    return tokens.withColumn("dl", F.size("tokens").cast("long"))


def postings(documents: DataFrame) -> DataFrame:
    """(doc_id, term, tf, dl, positions), one row per document and term.

    The tokens of a block of documents are sorted by word and document as numbers and cut
    into runs of equal ones, so no row is made per occurrence and no task holds more than a
    block, or a document that is longer. A block comes in the order of its terms, which a
    sort of the rows by term has only to merge.
    """
    blocks = token_blocks()

    def run(batches):
        for rows, sizes, numbers, found in blocks(batches):
            document = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rank = np.full(len(found) + 1, -1)
            rank[pc.array_sort_indices(found).to_numpy()] = np.arange(len(found))
            key = rank[numbers] * len(sizes) + document
            order = np.argsort(key, kind="stable")
            order = order[numbers[order] >= 0]
            starts = np.flatnonzero(np.diff(key[order], prepend=-1))
            cuts = np.append(starts, len(order))
            first = order[starts]
            owner = pa.array(document[first])
            columns = [
                rows.column("doc_id").take(owner),
                found.take(pa.array(numbers[first])),
                pa.array(np.diff(cuts)),
                rows.column("dl").take(owner),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(place[order], pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "term", "tf", "dl", "positions"])

    made = [
        documents.schema["doc_id"],
        T.StructField("term", T.StringType()),
        T.StructField("tf", T.LongType()),
        documents.schema["dl"],
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
    return documents.select("doc_id", "dl", "tokens").mapInArrow(run, T.StructType(made))


def vocabulary(posting_rows: DataFrame) -> DataFrame:
    return posting_rows.select("term").distinct()


def document_frequency(posting_rows: DataFrame) -> DataFrame:
    return posting_rows.groupBy("term").agg(F.count("*").alias("df"))


def document_frequency_of(tokens: DataFrame) -> DataFrame:
    """(term, df) of token arrays, added up by block of documents before they become rows."""
    blocks = token_blocks()

    def run(batches):
        for _, sizes, numbers, found in blocks(batches):
            document = np.repeat(np.arange(len(sizes)), sizes)[numbers >= 0]
            met = np.unique(document * len(found) + numbers[numbers >= 0]) % max(1, len(found))
            df = pa.array(np.bincount(met, minlength=len(found)))
            yield pa.RecordBatch.from_arrays([found, df], ["term", "df"])

    return tokens.select("tokens").mapInArrow(run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def term_stats(posting_rows: DataFrame, n_docs: Column) -> DataFrame:
    """(term, df, idf, bm25_idf)."""
    df = F.col("df")
    return document_frequency(posting_rows).select(
        "term",
        "df",
        weights.idf(n_docs, df).alias("idf"),
        weights.bm25_idf(n_docs, df).alias("bm25_idf"),
    )


def corpus_stats(documents: DataFrame) -> DataFrame:
    """One row: documents, documents with a token, their mean token count."""
    filled = F.when(F.col("dl") > 0, F.col("dl"))
    return documents.agg(
        F.count("*").alias("n_docs"),
        F.count(filled).alias("n_nonempty"),
        F.coalesce(F.avg(filled), F.lit(0.0)).alias("avgdl"),
    )


def token_counts(posting_rows: DataFrame) -> DataFrame:
    return posting_rows.groupBy("doc_id").agg(F.sum("tf").alias("dl"))


LENGTH_RATIO = 1.25  # of the longest to the shortest document of a class
LONGEST_CLASS = 62  # classes fit the bits of a long; the last one is open
FEW_POSTINGS = 64  # of a term that needs no bounds
RARE = 1000  # nor does one of less than one document in so many


def length_class(dl: Column) -> Column:
    number = F.floor(F.log(F.greatest(dl, F.lit(1))) / F.log(F.lit(LENGTH_RATIO)))
    return F.least(number, F.lit(LONGEST_CLASS)).cast("int")


def bounds(posting_rows: DataFrame, norms: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """(term, class, max_tf, min_dl, max_share): the largest share a frequent term has in
    documents of a length class. Postings stay in the buckets of their documents, and only
    the largest of each bucket are shuffled. The frequent terms are bounded in number by the
    words of a mean document."""
    held = terms.filter(F.col("df") > max(FEW_POSTINGS, n_docs // RARE)).select("term", "df")
    rows = posting_rows.select("doc_id", "term", "tf", "dl").join(norms, "doc_id")
    rows = lookup(rows, held, ["term"], weight="df")
    share = F.max(F.col("tf") / F.coalesce("l2", F.lit(1.0))).alias("max_share")
    most = [F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), share]
    return rows.groupBy("term", length_class(F.col("dl")).alias("class")).agg(*most)


def tfidf(posting_rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ``w``, the raw term count times idf (0 for a term without idf)."""
    stats = terms.select("term", "df", "idf")
    joined = lookup(posting_rows, stats, ["term"], weight="df", how="left")
    return joined.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(0.0)))


def document_norms(weighted: DataFrame) -> DataFrame:
    """(doc_id, l2) of the weights of each document."""
    return weighted.groupBy("doc_id").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l2")
    )


def normalise(weighted: DataFrame, norms: DataFrame) -> DataFrame:
    """Adds ``w_norm``; a document without a norm divides by 1."""
    return weighted.join(norms, "doc_id", "left").withColumn(
        "w_norm", F.col("w") / F.coalesce("l2", F.lit(1.0))
    )
