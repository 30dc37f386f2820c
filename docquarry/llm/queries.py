"""The registered queries of the subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import ann_bits, collocations, language, licenses, minhash, mixing, oracle, pieces
from docquarry.llm import repeats, secrets, spelling, toxicity, vector_dups, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann_bits.clean_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    codes = ann_bits.encode(vectors)
    asked = codes.filter(F.col("id") % 20 == 0).select("id", "vector")
    return ann_bits.search(codes, asked).withColumnRenamed("id", "vec_id")


MIX = {"good": 0.80, "low": 0.15, "toxic": 0.05}


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = mixing.train(mixing.label_domains(docs, _table(spark, sf_dir, "labels")))
    found = mixing.fit(docs.select("doc_id", "text"), model, MIX)
    chance = [F.get("posteriors", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return found.rated.select("doc_id", "tokens", *chance, "rate", F.lit(found.missed).alias("missed"))


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def coded(docs: DataFrame, model: str = PIECES) -> DataFrame:
    """Pieces of every text, and whether decoding them gives the text back."""
    known = pieces.load(model)
    given = F.sha2(F.coalesce("text", F.lit("")), 256).alias("given")
    decoded = pieces.recode(docs.select("doc_id", "text", given), known)
    told = F.sha2("decoded", 256)
    return decoded.select(
        "doc_id", "n_pieces", "ids", told.alias("decoded_sha256"), (told == F.col("given")).alias("round_trip")
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tested = language.held_out("doc_id", 4, 2)
    model = language.train(docs.filter(~tested).select("text", "lang"))
    return language.predict(docs.select("doc_id", tested.alias("held_out"), "text"), model).drop("text")


def op5_anchored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    kept = F.sha2("kept_text", 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def op6_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vector_dups.near_duplicates(vectors, "vec_id", "embedding").withColumnRenamed("id", "vec_id")


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc.archive(spark, _table(spark, sf_dir, "pages"))
    records = warc.read_archives(warc.open_archives(spark, manifest, folder))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tested = language.held_out("doc_id", 5, 0)
    index = toxicity.train(docs.filter(~tested), _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", tested.alias("held_out"), "text"), index)
    return scored.drop("text")


def op9_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"), F.lit(1).alias("version"), F.col("text").alias("content")
    )
    found = secrets.findings(versions, secrets.scan(versions))
    names = F.array(*[F.lit(rule.name) for rule in secrets.RULES])
    told = F.transform(
        "spans", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{rule.name}") for kind, rule in enumerate(secrets.RULES)]
    joined = F.array_join(told, ",")
    return found.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.text_words(_table(spark, sf_dir, "documents"), noise=97)
    return spelling.variants(words)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(_table(spark, sf_dir, "documents"))
    return found.withColumn("rank", F.col("rank").cast("long")).drop("words")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(template.label) for template in licenses.TEMPLATES])
    base = F.filter("places", lambda p: p["template"] < len(licenses.PHRASES))
    starts = F.transform(base, lambda p: p["start"])

    def labels(places):
        told = F.transform(places, lambda p: F.get(names, p["template"]))
        return F.array_join(F.array_sort(F.array_distinct(told)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_ann_bits": op1_ann_bits,
        "op2_soft_mixing": op2_soft_mixing,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_language_id": op4_language_id,
        "op5_anchored_repeats": op5_anchored_repeats,
        "op6_subspace_join": op6_subspace_join,
        "op7_warc_archive": op7_warc_archive,
        "op8_toxicity": op8_toxicity,
        "op9_minhash_join": op9_minhash_join,
        "op10_secret_scan": op10_secret_scan,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_collocations": op12_collocations,
        "op13_license_scan": op13_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
