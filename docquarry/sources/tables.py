"""Table sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)
LABELS_SCHEMA = T.StructType(
    [
        T.StructField("qid", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("cid", T.ArrayType(T.LongType())),
    ]
)
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("method", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("qid", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("retrieved", T.ArrayType(T.LongType())),
    ]
)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan; with a schema, its column names must be in the file."""
    if schema is None:
        return spark.read.parquet(path)
    found = set(spark.read.parquet(path).columns)
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame, input_bytes: int, *keys: str) -> DataFrame:
    """Spread over all cores by key if the scan would leave most of them idle.

    A small table stored as one row group is one task otherwise. One whose files, of
    ``input_bytes`` together, make a full split for every core is left as it is.
    """
    session = df.sparkSession
    cores = session.sparkContext.defaultParallelism
    split = session.conf.get("spark.sql.files.maxPartitionBytes")
    if input_bytes >= cores * _size(split):
        return df
    return df.repartition(cores, *keys)


def _size(text: str) -> int:
    """Bytes of a setting such as 128MB, 16m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One phrase per line, without Unicode blanks around it; blanks inside become '_'."""
    phrase = F.regexp_replace("value", r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")
    return (
        spark.read.text(path)
        .select(F.lower(F.replace(phrase, F.lit(" "), F.lit("_"))).alias("term"))
        .filter(F.col("term") != "")
        .distinct()
    )


def write_records(records: DataFrame, path: str) -> None:
    """Per-query results, one JSON dataset with a folder per method."""
    records.write.mode("overwrite").partitionBy("method").json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).json(path)


def write_summary(summary: DataFrame, path: str, fmt: str = "json") -> None:
    """Evaluation summary as ``json`` or ``csv``; one row per method and k."""
    writer = summary.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def export_corpus_json(corpus: DataFrame, path: str) -> None:
    corpus.select("doc_id", "text").write.mode("overwrite").json(path)


def export_questions_json(labels: DataFrame, path: str) -> None:
    """Label lists; ``part``, where there is one, tells lists of one question apart."""
    part = [c for c in ("part",) if c in labels.columns]
    labels.select("qid", *part, "question", "cid").write.mode("overwrite").json(path)
