"""The registered queries and the pipeline on a small table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference
from conftest import SMALL
from docquarry.llm import language
from docquarry.llm.queries import oracle_sql, queries

SQL = oracle_sql()


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got = queries()[name](spark, SMALL).toPandas()
    want = connect(SMALL).execute(SQL[name]).df()
    for column in want.columns:  # ids that may be null
        if got[column].dtype == "float64" and str(want[column].dtype) == "Int64":
            got[column] = got[column].astype("Int64")
    assert difference(got, want) is None and len(got)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(9001, None, "en", "s", None), (9002, "12 34", None, "s", 5), (9003, "the and that with " * 30 + "token=abcdef123", None, "s", 600)]
    odd += [(9004, odd[2][1], None, "s", 600), (9004, odd[2][1], None, "s", 600)]
    odd += [(None, "text of " + odd[2][1], None, "s", 600)] * 2 + [(9005, "other " * 40 + docs.first().text, "en", "s", 1)] * 2
    further = ["tokens", "posteriors", "rate", "score", "lang_pred", "_blob", "_spans", "_slots", "_copy", "row", "component_id"]
    now = docs.union(spark.createDataFrame(odd, docs.schema))
    now = now.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in further])
    given, docs, seen = docs.count(), now, {}
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialise(stage(spark, now, SMALL), name)
        seen[name] = now
        if name != "pieces":
            assert now.schema.names == docs.schema.names and now.dtypes == docs.dtypes
            for column in further:
                changed = now.filter(~F.col(column).eqNullSafe(F.concat(F.lit(f"{column} "), F.col("doc_id").cast("string"))))
                assert changed.isEmpty()
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in seen.items()}
    assert not {9001, 9002} & ids["language"] and {9003, 9004} <= ids["language"]
    assert 9003 in ids["near_duplicates"] and 9004 not in ids["near_duplicates"]
    near = seen["near_duplicates"]
    assert near.filter("doc_id = 9005").count() <= 1 and near.filter("doc_id IS NULL").count() <= 1
    assert "[assign]" in seen["secrets"].filter("doc_id = 9003").first().text
    assert seen["secrets"].filter("text RLIKE 'AKIA[A-Z0-9]{16}'").isEmpty()
    assert seen["secrets"].count() == seen["near_duplicates"].count()
    assert seen["pieces"].count() == seen["mixing"].count() and seen["pieces"].filter("NOT round_trip").isEmpty()
    assert len(ids["language"]) >= 0.99 * given


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (5, text + " end"), (5, text), (3, text + " or"), (3, text + " or"), (None, "alone"), (None, None), (9, None), (9, "b c")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(3, text + " or"), *rows[5:]], key=repr)


def test_languages_of_a_large_family_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rng, many = random.Random(3), []
    for number, lang in enumerate(["en", "de", "nl", "sv", "da", "no", "is", "fy"]):
        letters = [chr(97 + (5 * number + i) % 26) for i in range(12)]
        words = ["".join(rng.choices(letters, k=rng.randrange(2, 7))) for _ in range(200)]
        many += [(100 * number + i, " ".join(rng.choices(words, k=60)), lang, "s", 300) for i in range(40)]
    table = spark.createDataFrame(many, docs.schema)
    kept = corpus_pipeline.language_stage(spark, table, SMALL)
    assert kept.count() >= 0.98 * len(many)
    told = language.predict(table, language.train(table)).collect()
    right = [r.score for r in told if r.lang == r.lang_pred]
    assert len(right) >= 0.98 * len(many) and sorted(right)[len(right) // 2] > 0.8


def test_empty_corpus(spark):
    now = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialise(stage(spark, now, SMALL), name)
    assert now.isEmpty()
