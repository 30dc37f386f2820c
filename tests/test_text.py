"""Cleaning, tokenising, stopwords and compounds."""

import random
import re
import unicodedata

import pytest
import regex
from pyspark.sql import functions as F

from conftest import tuples
from docquarry.functions import text as t
from docquarry.functions.fixed import CHARSET_RE, TOKEN_RE
from docquarry.operators import blocks, compounds, corpus
from docquarry.sources.tables import read_stopwords


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def tokens_of(spark, texts):
    rows = corpus.tokenise(corpus.clean(docs(spark, texts))).collect()
    return [list(r.tokens) for r in sorted(rows)]


def test_text_preparation_examples(spark):
    decomposed = unicodedata.normalize("NFD", "Kế Toán x")
    cases = [
        (None, []),
        ("", []),
        (decomposed, ["kế", "toán"]),
        ("thuế�VAT", ["thuế", "vat"]),
        ("a an I'm façade 3.5 e-mail", ["an", "3.5", "e-mail"]),
        ("one..two .three- four_five", ["one", "two", "three", "four_five"]),
        ("Straße ab-çd xy", ["xy"]),
    ]
    assert tokens_of(spark, [text for text, _ in cases]) == [want for _, want in cases]


def test_tokens_match_a_plain_reading_of_the_rules(spark):
    rng = random.Random(7)
    alphabet = "aAbZ09_.-  \n,'çéÉđĐẫ中文́�İ\t"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)]

    def plain(text):
        cleaned = unicodedata.normalize("NFC", text).lower().replace("�", " ")
        return [
            w
            for w in regex.findall(TOKEN_RE, cleaned)
            if len(w) > 1 and re.fullmatch(CHARSET_RE, w)
        ]

    assert tokens_of(spark, texts) == [plain(text) for text in texts]


def test_long_dotted_token_does_not_overflow(spark):
    assert tokens_of(spark, ["a." * 200_000 + "a"]) == [["a." * 200_000 + "a"]]


def test_stable_blocks_really_are_stable():
    composing = set()
    for point in range(0x110000):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            composing.add(int(parts[1], 16))
    ranges = re.findall(
        r"\\u([0-9A-F]{4})(?:-\\u([0-9A-F]{4}))?", t.NFC_STABLE_LATIN + t.NFC_STABLE_OTHER
    )
    assert len(ranges) == 10
    for low, high in ranges:
        for point in range(int(low, 16), int(high or low, 16) + 1):
            char = chr(point)
            assert unicodedata.is_normalized("NFC", char), hex(point)
            assert unicodedata.combining(char) == 0, hex(point)
            assert point not in composing, hex(point)


def test_nfc_of_every_kind_of_text(spark):
    texts = ["plain", "é", "Å", "한글", "한", "が", "Кий", "ệ", "\U0001d15e"]
    got = docs(spark, texts).select("doc_id", t.nfc(F.col("text")).alias("n")).orderBy("doc_id")
    assert [r.n for r in got.collect()] == [unicodedata.normalize("NFC", x) for x in texts]


def test_stopword_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text(" Bởi vì \n\nbởi vì\n\tCỦA\t\n   \na b c\n", encoding="utf-8")
    assert tuples(read_stopwords(spark, str(path))) == [("a_b_c",), ("bởi_vì",), ("của",)]


@pytest.mark.parametrize("limit,in_place", [(64 << 20, 10), (64 << 20, 0), (0, 10)])
def test_stopwords_keep_repeats_and_empty_documents(
    spark, setting, monkeypatch, limit, in_place
):
    monkeypatch.setattr(corpus, "STOPWORDS_IN_PLACE", in_place)
    tokens = spark.createDataFrame(
        [(1, ["tax", "of", "tax"]), (2, ["of"]), (3, [])], "doc_id long, tokens array<string>"
    )
    stop = spark.createDataFrame([("of",)], "term string")
    with setting("docquarry.broadcastBytes", limit):
        got = tuples(corpus.drop_stopwords(tokens, stop))
        unlisted = tuples(corpus.drop_stopwords(tokens, stop.limit(0)))
    assert got == [(1, ["tax", "tax"]), (2, []), (3, [])]
    assert unlisted == tuples(tokens)


def greedy(words, lexicon):
    out, i = [], 0
    while i < len(words):
        if i + 1 < len(words) and (words[i], words[i + 1]) in lexicon:
            out.append(words[i] + "_" + words[i + 1])
            i += 2
        else:
            out.append(words[i])
            i += 1
    return out


def test_compound_example(spark):
    words = spark.createDataFrame(
        [(1, "a1 b1 c1 d1 e1".split())], "doc_id long, tokens array<string>"
    )
    lexicon = spark.createDataFrame(
        [("a1", "b1", 1), ("b1", "c1", 1), ("c1", "d1", 1)], "t1 string, t2 string, n long"
    )
    assert tuples(compounds.join_compounds(words, lexicon)) == [(1, ["a1_b1", "c1_d1", "e1"])]


@pytest.mark.parametrize("limit", [64 << 20, 300, 0])
def test_compounds_against_a_greedy_scan(spark, setting, limit):
    rng = random.Random(3)
    data = [(i, rng.choices("abcd", [6, 3, 2, 1], k=rng.randint(0, 30))) for i in range(200)]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>")
    lexicon = compounds.learn_lexicon(words, 150)
    counts = {}
    for _, tokens in data:
        for pair in zip(tokens, tokens[1:]):
            counts[pair] = counts.get(pair, 0) + 1
    known = {pair: n for pair, n in counts.items() if n >= 150}
    assert {(r.t1, r.t2): r.n for r in lexicon.collect()} == known
    assert 2 < len(known) < len(counts)
    with setting("docquarry.broadcastBytes", limit):
        got = tuples(compounds.join_compounds(words, lexicon))
    assert dict(got) == {i: greedy(tokens, known) for i, tokens in data}


def test_rare_pairs_are_not_shuffled_as_texts(spark, tmp_path):
    """Nine of ten pairs are seen once; their words are in no shuffle."""
    data = [(i, ["the", "same", f"x{i}", f"y{i}"] + ["the", "same"] * (i % 2)) for i in range(300)]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>").repartition(4, "doc_id")
    lexicon = compounds.learn_lexicon(words, 100)
    assert tuples(lexicon) == [("the", "same", 450)]
    twice = compounds.learn_lexicon(words, 100, again=words.repartition(2))
    assert tuples(twice) == tuples(lexicon)
    plan = lexicon._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("HashAggregate") and "frequent-codes" in plan


def test_compounds_make_no_row_per_word(spark):
    """No window, and only places of found pairs are grouped; null and empty rows stay."""
    data = [(1, "a b a b c".split()), (2, []), (3, None), (None, "a b a".split()), (4, "c b".split())]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>")
    lexicon = spark.createDataFrame([("a", "b", 3), ("b", "c", 1), ("b", "a", 1)], "t1 string, t2 string, n long")
    joined = compounds.join_compounds(words, lexicon)
    want = [(1, ["a_b", "a_b", "c"]), (2, []), (3, []), (4, ["c", "b"]), (None, ["a_b", "a"])]
    assert tuples(joined) == sorted(want, key=repr)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "token#" not in plan


def test_compounds_stay_with_their_documents(spark, monkeypatch):
    """No row per pair, no shuffle and no sort; blocks of any size give the same rows."""
    rng = random.Random(5)
    data = [(i % 50 or None, rng.choices(["a", "b", "ç", "_"], k=rng.randint(0, 12))) for i in range(120)]
    data += [(7, None), (7, []), (8, ["a"] * 300)]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>")
    pairs = [("a", "a", 3), ("a", "ç", 2), ("ç", "b", 1), ("_", "a", 1), (None, "a", 9), ("a", "a", 3)]
    lexicon = spark.createDataFrame(pairs, "t1 string, t2 string, n long")
    want = sorted([(i, greedy(t or [], {p[:2] for p in pairs})) for i, t in data], key=repr)
    for most in (500_000, 7):
        monkeypatch.setattr(blocks, "BLOCK_TOKENS", most)
        joined = compounds.join_compounds(words, lexicon)
        assert tuples(joined) == want
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("Join", "Exchange", "Generate", "Sort"))
        assert dict(tuples(compounds.join_compounds(words.limit(0), lexicon))) == {}
        assert tuples(compounds.join_compounds(words, lexicon.limit(0))) == sorted([(i, t or []) for i, t in data], key=repr)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_valid_tokens_of_compounds(spark, setting, limit):
    """Validity is asked once per word of a block, and is that of a token."""
    odd = ["a", "ab", "ç", "çé", "ăb", "ăb\n", "ăb\u2028", "ăb\r\n", "ăb\n\n", "ab\n", "", "a b", "ăB", "đ.-", "日本", "e\u0301x", "x" * 50]
    data = [(i, [w, "x", "y", w, w]) for i, w in enumerate(odd)] + [(99, odd), (100, []), (101, None)]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>")
    lexicon = spark.createDataFrame([("ç", "x", 1), ("x", "y", 1), ("y", "日本", 1)], "t1 string, t2 string, n long")
    want = tuples(corpus.keep_valid(compounds.join_compounds(words, lexicon)))
    with setting("docquarry.broadcastBytes", limit):
        assert tuples(compounds.join_compounds(words, lexicon, only_valid=True)) == want
    assert tuples(compounds.token_arrays_of(words, lexicon)) == want
    assert tuples(compounds.token_arrays_of(words)) == tuples(corpus.keep_valid(words))


@pytest.mark.parametrize("slots", [1, 5, None])
def test_pairs_are_counted_by_block(spark, monkeypatch, slots):
    """Their hashes become no rows, and a pair does not reach over the end of a document."""
    rng = random.Random(4)
    data = [(i, rng.choices("abcdefgh", range(8, 0, -1), k=rng.randint(0, 9)) if i % 9 else None) for i in range(400)]
    words = spark.createDataFrame(data, "doc_id long, tokens array<string>").repartition(3)
    counts = {}
    for _, tokens in data:
        for pair in zip(tokens or [], (tokens or [])[1:]):
            counts[pair] = counts.get(pair, 0) + 1
    for most in (500_000, 20):
        monkeypatch.setattr(blocks, "BLOCK_TOKENS", most)
        lexicon = compounds.learn_lexicon(words, 20, slots=slots)
        assert {(r.t1, r.t2): r.n for r in lexicon.collect()} == {p: n for p, n in counts.items() if n >= 20}
        counted = compounds._frequent_codes(words, 20, 4)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "HashAggregate" not in plan
    assert compounds.learn_lexicon(words.limit(0), 20).isEmpty()


def test_one_row_per_id(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "doc_id long, text string")
    assert corpus.has_duplicate_ids(rows)
    assert tuples(corpus.one_row_per_id(rows)) == [(1, "a"), (2, None)]
    assert not corpus.has_duplicate_ids(corpus.one_row_per_id(rows))


def test_frequent_tokens_are_not_shuffled(spark, setting):
    rng = random.Random(2)
    rows = [(i, ["hot", "warm"] * 20 + [f"w{rng.randrange(400)}" for _ in range(10)]) for i in range(60)]
    rows += [(90, []), (91, None), (92, ["hot"])]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    listed = ["hot", *(f"w{i}" for i in range(200)), *(f"x{i}" for i in range(2000))]
    stop = spark.createDataFrame([(w,) for w in listed], "term string")
    want = [(i, [w for w in t or [] if w not in set(listed)]) for i, t in rows]
    with setting("docquarry.broadcastBytes", 2_000), setting("spark.sql.autoBroadcastJoinThreshold", -1):
        assert tuples(corpus.drop_stopwords(tokens, stop)) == sorted(want, key=repr)
        in_place, light = corpus.heavy_and_light(tokens, stop.withColumnRenamed("term", "token"))
        assert in_place.select("token").distinct().collect() == [("warm",)]
        assert light.filter("token IN ('hot', 'warm')").isEmpty() and light.count() == 600
        plan = light._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
    with setting("docquarry.broadcastBytes", 0), setting("spark.sql.autoBroadcastJoinThreshold", -1):
        assert tuples(corpus.drop_stopwords(tokens, stop)) == sorted(want, key=repr)
