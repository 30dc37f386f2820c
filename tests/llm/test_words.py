"""Spelling variants, collocations and license notices against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import collocations, licenses, spelling

DOCS = "doc_id long, text string, lang string, score double, word string, n string"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with those of the operators."""
    full = [(*row, None)[:3] if len(row) == 2 else row for row in rows]
    return spark.createDataFrame([(*row, 7.0, "w", "n") for row in full], DOCS)


# spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def grouped(counts, factor=2):
    rows = {}
    for word, n in counts.items():
        near = sorted((-counts[w], w) for w in counts if one_edit(word, w))
        chosen = near and -near[0][0] >= factor * n
        rows[word] = (near[0][1] if chosen else None, n, len(near), -near[0][0] if chosen else None)

    def root(word):
        return root(rows[word][0]) if rows[word][0] else word

    return sorted((w, f, root(w), n, near, fn) for w, (f, n, near, fn) in rows.items())


@pytest.mark.parametrize("kind", ["dense", "prefix", "suffix", "wide"])
def test_variants_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    letters = "abé" if kind != "wide" else "abcdefgh\U0001f600ü"
    counts = Counter()
    while len(counts) < 300:
        word = "".join(rng.choices(letters, k=rng.randrange(4, 9)))
        word = {"prefix": "abababab" + word, "suffix": word + "babababa"}.get(kind, word)
        counts[word] = rng.choice([1, 2, 3, 3, 4, 7, 15, 40])
    rows = [(w, n) for w, n in counts.items() if n > 1] + [(w, 1) for w, n in counts.items() if n == 1]
    rows += [(w, 1) for w in list(counts)[:50]]  # repeated rows are added up
    for w in list(counts)[:50]:
        counts[w] += 1
    expected = grouped({w: n for w, n in counts.items() if n >= 3 and len(w) >= 5})
    table = spark.createDataFrame([(w, n, 1) for w, n in rows], "word string, n long, best int")
    got = spelling.variants(table, block=16)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected


def test_blocks_hold_every_prefix():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("ab\U0010ffff", k=rng.randrange(1, 7))) for _ in range(300)})
    blocks = spelling.Blocks(words[10::10])
    for word in words:
        for split in range(len(word) + 1):
            wanted = {blocks.of(w) for w in words if w.startswith(word[:split])}
            assert wanted <= set(blocks.of_prefix(word[:split]))


def test_words_and_noise(spark):
    texts = {
        1: "Straße ÉTUDE étude × × x_abcde abcdefg 12abcdeABCDE naïve'naïve",
        2: None,
        3: "",
        4: " ".join("word" + chr(97 + i % 26) * (1 + i % 7) for i in range(3000)),
        None: "lonely Lonely",
    }
    expected = Counter()
    for number, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                expected[run] += 1
    rows = spelling.text_words(docs_of(spark, list(texts.items())), noise=3)
    got = {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    assert got == expected and "Étude".replace("É", "É") not in got


def test_variants_of_odd_tables(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).isEmpty()
    odd = spark.createDataFrame([(None, 9), ("", 9), ("words", 9), ("wordsx", 3), ("wordsxy", 1)], "word string, n long")
    assert sorted(map(tuple, spelling.variants(odd).collect())) == [
        ("words", None, "words", 9, 1, None),
        ("wordsx", "words", "words", 3, 1, 9),
    ]


def test_long_chains_end_at_their_root(spark):
    chain = [("a" * (5 + i), 3 * 2 ** (20 - i)) for i in range(20)]
    got = spelling.variants(spark.createDataFrame(chain, "word string, n long"))
    assert {r.root for r in got.collect()} == {"aaaaa"}


# collocations


def phrases_of(rows, longest):
    found, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    found[lang, tuple(words[i : i + k])] += 1
    return found, totals


def best_phrases(rows, threshold, longest, top):
    found, totals = phrases_of(rows, longest)
    frequent = {key: f for key, f in found.items() if f >= threshold}
    by_lang = defaultdict(list)
    longer = defaultdict(int)  # the most frequent longer phrase around each
    for (lang, words), f in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(longer[lang, words[i : i + k]], f)
    for (lang, words), a in frequent.items():
        if len(words) < 2 or longer[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = found[lang, words[:k]], found[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(words).encode(), left, right, totals[lang]))
    out = []
    for lang, every in by_lang.items():
        for rank, (score, a, text, left, right, n) in enumerate(sorted(every)[:top], 1):
            out.append((lang, rank, text.decode(), -a, left, right, n, -score))
    return sorted(out)


def sentences(rng, n, lang):
    words = [c * k for c in "abcÉ" for k in (1, 2)] + ["A", "the"]
    rows = []
    for i in range(n):
        line = rng.choices(words, k=rng.randrange(0, 30))
        if rng.random() < 0.5:
            line += ["New", "york", "city", "hall", "steps"][: rng.randrange(2, 6)]
        glue = [rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for _ in line]
        rows.append((i, "".join(w + g for w, g in zip(line, glue)), lang))
    return rows


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("table_bytes", [None, 4096])
def test_collocations_equal_brute_force(spark, monkeypatch, table_bytes):
    rng = random.Random(5)
    rows = sentences(rng, 120, "en") + sentences(rng, 60, None) + sentences(rng, 30, "und") + sentences(rng, 9, "xx")
    rows += [(1, None, "en"), (None, "", "fr"), (5, " . ,", "de"), (5, "one  one " * 4000, "de"), (5, "one  one " * 10, "de")]
    if table_bytes:  # many candidates for a small table: counted in rounds
        monkeypatch.setattr(collocations, "PART_BYTES", 500)
        rows += [(i, " ".join(f"w{j}" for j in range(i, i + 60)), "many") for i in range(0, 3000, 50)] * 4
    got = collocations.collocations(docs_of(spark, rows).repartition(3), 4, 5, 25, table_bytes)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == best_phrases(rows, 4, 5, 25)


def test_small_batches_and_equal_hashes(spark, monkeypatch):
    rows = sentences(random.Random(6), 80, "en") + sentences(random.Random(7), 40, "fr")
    same = collocations.Phrases([r[1] for r in rows], [r[2] for r in rows])
    expected, _ = phrases_of(rows, 3)
    for size in (1, 2, 3):
        at = same.starts(size)
        told = Counter()
        for lang, text, n in same.counted(size, at, np.zeros(len(at), np.uint64)):  # all hashes collide
            told[lang, tuple(text.split(" "))] += n
        assert told == {key: f for key, f in expected.items() if len(key[1]) == size}


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    keys = np.concatenate([rng.integers(0, 50_000, 40_000), np.repeat(np.arange(90_000, 90_030), 200)]).astype(np.uint32)
    rng.shuffle(keys)
    threshold = 200
    whole = collocations.Summary(len(keys) // threshold + 1)
    for part in np.array_split(keys, 37):
        distinct, counts = np.unique(part, return_counts=True)
        whole.merge(distinct, counts)
        assert len(whole.keys) <= whole.capacity
    assert whole.error < threshold
    exact = dict(zip(*np.unique(keys, return_counts=True)))
    held = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
    assert all(held[k] > 0 for k, n in exact.items() if n >= threshold)
    assert all(n <= exact[k] <= n + whole.error for k, n in held.items())


def test_collocations_beyond_64_bits(spark):
    """Scores stay exact where the products do not fit 64 bits."""
    a, f, n = 3_000_000_000_001, 3_000_000_000_007, 90_000_000_000_011
    counts = [("en", "x", 1, f), ("en", "y", 1, f), ("en", "x y", 2, a)]
    counts = spark.createDataFrame(counts, "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    phrases = counts.filter("words > 1").withColumnRenamed("f", "a")
    row = collocations.weakest_cuts(phrases, counts, totals).first()
    assert row.score == 1000 * a * n // (f * f)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(docs_of(spark, [])).isEmpty()
    assert collocations.collocations(docs_of(spark, [(1, None, None), (2, "", "en")])).isEmpty()


# license notices

NOTICES = (
    licenses.phrase("p", "cc by nc"),
    licenses.phrase("q", "by by"),
    licenses.Template("t", "this is free software under the terms of the nc public license", ("free software", "nc public")),
    licenses.Template("u", "all rights reserved", percent=60, slack=1),
    licenses.Template("t", "no key here at all", slack=2),
)


def all_places(texts, templates):
    """Every offset of every template, tested word by word."""
    worded = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    held = Counter(w for words in worded for w in set(words))
    out = []
    for words in worded:
        found = []
        for number, t in enumerate(templates):
            own = [w.decode() for w in t.words]
            weights = [licenses.weight(len(texts), held[w]) for w in own]
            good = []
            for start in range(-len(own) - t.slack, len(words) + t.slack + 1):
                support = 0
                for p, word in enumerate(own):
                    near = range(start + p - t.slack, start + p + t.slack + 1)
                    support += weights[p] * any(0 <= i < len(words) and words[i] == word for i in near)
                keyed = all(
                    any(
                        i >= 0 and words[i : i + len(key)] == [w.decode() for w in key]
                        for i in range(start - t.slack, start + len(own) - len(key) + t.slack + 1)
                    )
                    for key in t.key_words
                )
                exact = sum(w for p, w in enumerate(weights) if 0 <= start + p < len(words) and words[start + p] == own[p])
                if 100 * support >= t.percent * sum(weights) and keyed:
                    good.append((-support, -exact, start))
            kept = []
            for support, _, start in sorted(good):
                if not t.slack or all(abs(start - s) >= len(own) for s, _ in kept):
                    kept.append((start, -support / sum(weights)))
            found += [(number, max(s, 0), round(score, 9)) for s, score in sorted(kept)]
        out.append((len(words), found))
    return out


def test_places_equal_brute_force(spark):
    rng = random.Random(8)
    vocabulary = sorted({w.decode() for t in NOTICES for w in t.words}) + ["x", "É", "12"]
    texts = [None, "", "...", "CC-BY, nc" * 3, "cc by ncx", "by By-BY", "All Rights", "rights reserved " * 500]
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(1, 40))
        if rng.random() < 0.7:
            notice = list(rng.choice(NOTICES).text.split())
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(notice))
                if rng.random() < 0.5:
                    notice[at] = rng.choice(vocabulary)
                else:
                    notice.insert(at, rng.choice(vocabulary))
            at = rng.randrange(len(words))
            words[at:at] = notice
        texts.append(" ".join(rng.choice([w, w.upper() if w.isascii() else w]) for w in words))
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] + [(3, texts[20])]
    got = licenses.find(docs_of(spark, rows), NOTICES).collect()
    expected = all_places([t for _, t in rows], NOTICES)
    key = lambda r: (r[0] is None, r[0] or 0, repr(r[1:]))
    told = [(r.doc_id, r.n_words, [(p.template, p.start, round(p.score, 9)) for p in r.places]) for r in got]
    assert sorted(told, key=key) == sorted([(i, *e) for (i, _), e in zip(rows, expected)], key=key)


def test_real_notices_are_found_despite_changes(spark):
    mit = next(t for t in licenses.NOTICES if t.label == "mit").text
    changed = mit.replace("associated documentation files", "the associated docs").replace("sublicense", "sub-license")
    texts = ["x " * 50 + mit, changed, mit.replace("without restriction", "with restriction"), "free of charge " * 30]
    got = licenses.find(docs_of(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    labels = [{licenses.TEMPLATES[p.template].label for p in r.places} for r in got]
    assert labels == [{"mit"}, {"mit"}, set(), set()] and got[0].places[0].start == 50


def test_places_of_an_empty_table(spark):
    assert licenses.find(docs_of(spark, [])).isEmpty()


def test_every_key_stands_in_its_template():
    for t in licenses.TEMPLATES:
        for key in t.key_words:
            assert any(t.words[i : i + len(key)] == key for i in range(len(t.words)))
