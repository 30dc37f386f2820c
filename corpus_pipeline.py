"""A corpus pipeline: each stage reads what its predecessor kept and calls one operator.

All but the last stage return the columns of `documents`, with the stage's decisions in
effect: rejected languages and repeated documents are gone, secrets are replaced, and
documents are repeated or left out as their mixing rates say. The last one returns the
pieces of every document.

Texts that are null or have no letter are rejected by the first stage; rows without an id
and rows that repeat an id go through all stages as documents of their own; further
columns, whatever their names, stay as they are. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import language, minhash, mixing, secrets
from docquarry.llm.queries import MIX, coded
from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise

LEAST_SCORE = 0.3  # of a language; clear texts of a few words score far higher
WHOLE = ("good", "low")  # domains that mixing repeats if need be, but does not thin out


def _packed(docs: DataFrame, *apart: str) -> DataFrame:
    """``docs`` as a struct `kept` and the columns an operator works on, so that what it
    adds never meets a column of the same name."""
    rest = [name for name in docs.columns if name not in apart]
    return docs.select(F.struct(*rest).alias("kept"), *apart)


def _unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs``, in their order, from packed rows."""
    held = rows.schema["kept"].dataType.names
    changed = {name: column.alias(name) for name, column in changed.items()}
    columns = [changed.get(name, F.col("kept")[name].alias(name) if name in held else F.col(name)) for name in docs.columns]
    return rows.select(*columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a language that was learned from the labelled rows; fills in
    languages that are missing."""
    model = language.train(docs.select("text", "lang"))
    told = language.predict(_packed(docs, "text"), model)
    known = told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return _unpacked(known, docs, lang=F.coalesce(F.col("kept")["lang"], F.col("lang_pred")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that with the smallest id (none
    after any), and of several with that id the one with the smallest text hash. Rows are
    compared each for itself, whether they repeat an id or have none."""
    row = F.monotonically_increasing_id().alias("row")
    rows = materialise(docs.select(row, F.struct("*").alias("kept")), "numbered")
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("kept.text").alias("text")))
    found = materialise(found.filter("component_id IS NOT NULL").select(F.col("doc_id").alias("row"), "component_id"), "groups")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    members = found.join(several, "component_id")
    ids = rows.select("row", F.col("kept.doc_id").alias("id"), F.xxhash64("kept.text").alias("hash"))
    members = materialise(ids.join(broadcast_if_small(materialise(members, "members")), "row"), "members")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "row"))
    kept = members.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    gone = materialise(members.select("row").join(kept, "row", "left_anti"), "repeated-rows")
    return rows.join(broadcast_if_small(gone), "row", "left_anti").select("kept.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kind."""
    versions = docs.select(
        F.col("doc_id").alias("path"), F.lit(1).alias("version"), F.col("text").alias("content")
    )
    apart = [name for name in ("text", "n_chars") if name in docs.columns]
    return _unpacked(secrets.redacted(_packed(docs, *apart), secrets.scan(versions)), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that expected tokens meet the target shares."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mixing.train(mixing.label_domains(docs, labels))
    rated = mixing.fit_rates(_packed(docs, "text"), model, MIX, growth=None, whole=WHOLE)
    return _unpacked(mixing.resample(rated), docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text into pieces and checks that they decode to it."""
    return coded(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("pieces", piece_stage),
]

# The classifiers, the fitted rates and the pieces cannot be written in SQL; the stages
# are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
