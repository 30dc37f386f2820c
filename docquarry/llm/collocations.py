"""Phrase collocations: frequent phrases whose words stand together more than chance says.

Frequent phrases are found in two passes over the texts.

1. Mergeable Misra-Gries summaries per hash partition. A task counts the phrases (of one
   to ``longest`` words, by hash) of a few million words at a time; these counts are
   summaries that never had to drop anything, cut into hash partitions and shuffled
   packed. Each partition merges its summaries into one with a capacity above its mass
   divided by the threshold: when it overflows, the counter that is first beyond the
   capacity is taken off all. Every such step takes it off more than ``capacity``
   counters, so a phrase loses less than mass / capacity, that is less than the threshold,
   and every frequent phrase keeps a positive counter. Counters that, with all that was
   taken off, stay below the threshold are no candidates.
2. Counts, exactly. The candidates make a bit table of bounded size, built by Spark; only
   phrases whose bit is set leave the texts, as words, and are added up. A phrase that is
   there by chance fails the threshold. Candidates beyond the table's room are counted in
   further rounds, each with the table of some hash partitions.

The number of partitions follows from the size of the texts, so a task merges a few
million counters at any size; a phrase that makes up a third of all is one entry for a few
million words. Phrases with equal hashes are told apart by their words.

Defined results: A-Z in lower case; a null text is empty, a null language ``und``; words
are parted by blanks and tabs and do not cross ``.,;:!?`` or line breaks; repeated rows
count each; further columns are ignored; an empty table gives an empty result; one text
must fit a task's memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.repeats import mix, numbers
from docquarry.operators.joins import broadcast_if_small, broadcast_limit
from docquarry.sources.shared import materialise

PART_BYTES = 8 << 20  # of text for each hash partition
CHUNK_BYTES = 1 << 20  # of text worked on as arrays
HELD = 1_000_000  # counters that a task holds before it sends them
UNKNOWN = "und"

SUMMARIES = "part int, mass long, keys binary, counts binary"
CANDIDATES = "part int, spot long"
COUNTED = "lang string, phrase string, words int, f long"

# fixed values: 0 part of a word, 1 between words, 2 between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2


class Phrases:
    """The words of some texts as numbers, and where phrases start.

    ``words`` are the distinct ones, ``ids`` the place of each occurrence among them,
    ``piece`` the number of its piece and ``lang`` that of its language.
    """

    def __init__(self, texts: list[str | None], langs: list[str | None]):
        raw = [(t or "").encode().lower() for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        kind = _KIND[data]
        solid = kind == 0
        edges = np.diff(np.r_[False, solid, False].astype(np.int8))
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = np.r_[0, np.cumsum(end - begin)].astype(np.int32)
        inner = np.ascontiguousarray(data[solid])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(inner)]
        coded = pa.Array.from_buffers(pa.binary(), len(begin), buffers).dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False)
        self.words = coded.dictionary.to_pylist()
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        starts = np.cumsum([0, *(len(t) + 1 for t in raw)])
        told = [lang if lang is not None else UNKNOWN for lang in langs]
        self.langs = sorted(set(told))
        number = {lang: i for i, lang in enumerate(self.langs)}
        of_text = np.array([number[lang] for lang in told], np.int32)
        self.lang = np.repeat(of_text, np.diff(np.searchsorted(begin, starts)))
        self._hash = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        self._salt = np.array([xxhash.xxh64_intdigest(l.encode(), 1) for l in self.langs], np.uint64)

    def starts(self, size: int) -> np.ndarray:
        """Where phrases of ``size`` words start."""
        n = max(0, len(self.piece) - size + 1)
        return np.flatnonzero(self.piece[size - 1 :][:n] == self.piece[:n])

    def hashes(self, size: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the phrases that start there, with their language."""
        total = np.zeros(len(at), np.uint64)
        for k, factor in enumerate(numbers(size, 11)):
            total += self._hash[self.ids[at + k]] * factor
        return mix(total) ^ self._salt[self.lang[at]]

    def counted(self, size: int, at: np.ndarray, hashes: np.ndarray):
        """(language, phrase, count) of the phrases that start there."""
        _, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        like = at[first][inverse]
        same = self.lang[at] == self.lang[like]
        for k in range(size):
            same &= self.ids[at + k] == self.ids[like + k]
        if not same.all():  # unlike phrases with one hash
            counts = np.bincount(inverse[same], minlength=len(first))
            yield from self.counted(size, at[~same], hashes[~same])
        for start, n in zip(at[first].tolist(), counts.tolist()):
            words = [self.words[i] for i in self.ids[start : start + size].tolist()]
            yield self.langs[self.lang[start]], b" ".join(words).decode(), n


def _chunks(batches):
    """Phrases of the texts (text, lang), a few megabytes at a time."""
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or "") + 1
            if size >= CHUNK_BYTES or i == len(texts) - 1:
                yield Phrases(texts[first : i + 1], langs[first : i + 1])
                first, size = i + 1, 0


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by at most ``error``."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys, counts = added_up(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        beyond = len(keys) - self.capacity - 1
        if beyond >= 0:
            cut = np.partition(counts, beyond)[beyond]  # the largest that has no room
            self.error += int(cut)
            left = counts > cut
            keys, counts = keys[left], counts[left] - cut
        self.keys, self.counts = keys, counts


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _spots(part: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """63-bit numbers of (partition, key), whose low bits pick the bit of a table."""
    return mix(part.astype(np.uint64) << np.uint64(32) | keys.astype(np.uint64)) >> np.uint64(1)


def summaries(texts: DataFrame, longest: int, parts: int) -> DataFrame:
    """Packed summaries (see SUMMARIES) of the phrases of (text, lang)."""
    schema = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        held, size = [], 0

        def packed():
            hashes, counts = added_up(*(np.concatenate(c) for c in zip(*held)))
            cuts = np.searchsorted(_part_of(hashes, parts), np.arange(parts + 1, dtype=np.uint64))
            low, rows = hashes.astype(np.uint32), []
            for part in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[part], cuts[part + 1]
                keys, n = added_up(low[a:b], counts[a:b])
                rows.append((part, n.sum(), keys.tobytes(), n.astype(np.uint32).tobytes()))
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for phrases in _chunks(batches):
            every = [phrases.hashes(n, phrases.starts(n)) for n in range(1, longest + 1)]
            hashes = np.concatenate(every)
            if not len(hashes):
                continue
            held.append(np.unique(hashes, return_counts=True))
            size += len(held[-1][0])
            if size >= HELD:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    return texts.mapInArrow(run, SUMMARIES)


def candidates(sent: DataFrame, threshold: int) -> DataFrame:
    """(part, spot) of a superset of the phrases with at least ``threshold`` occurrences."""

    def merged(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        mass = sum(table["mass"].to_pylist())
        summary = Summary(mass // threshold + 1)
        waiting, size = [], 0
        for place in range(table.num_rows):
            keys = np.frombuffer(table["keys"][place].as_buffer(), np.uint32)
            counts = np.frombuffer(table["counts"][place].as_buffer(), np.uint32).astype(np.int64)
            waiting.append((keys, counts))
            size += len(keys)
            if size > 4 * summary.capacity or place == table.num_rows - 1:
                summary.merge(*(np.concatenate(c) for c in zip(*waiting)))
                waiting, size = [], 0
        keys = summary.keys[summary.counts + summary.error >= threshold]
        spots = _spots(np.full(len(keys), part), keys).astype(np.int64)
        return pa.table({"part": pa.array(np.full(len(keys), part, np.int32)), "spot": pa.array(spots)})

    return sent.groupBy("part").applyInArrow(merged, CANDIDATES)


def _table(found: DataFrame, bits: int) -> np.ndarray:
    """The bits of the candidates' spots, as bytes."""
    spot = F.col("spot").bitwiseAND(F.lit(bits - 1)) + 1
    blocks = found.groupBy(F.bitmap_bucket_number(spot).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap")
    )
    out = np.zeros(max(1, bits // 8), np.uint8)
    for row in blocks.toLocalIterator():
        part = np.frombuffer(bytes(row.bitmap), np.uint8)
        start = (row.block - 1) * 4096
        out[start : start + len(part)] = part[: len(out) - start]
    return out


def exact_counts(texts: DataFrame, longest: int, parts: int, kept: range, table: np.ndarray) -> DataFrame:
    """(lang, phrase, words, f) of the phrases of the partitions ``kept`` with a bit in
    the table; ``f`` is to be added up. The words of each language come along as a null
    phrase of no words with the first partition."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])
    mask = np.uint64(8 * len(table) - 1)

    def run(batches):
        bits = shared.value
        for phrases in _chunks(batches):
            rows = []
            if kept.start == 0:
                totals = np.bincount(phrases.lang, minlength=len(phrases.langs)).tolist()
                rows += [(lang, None, 0, n) for lang, n in zip(phrases.langs, totals) if n]
            for size in range(1, longest + 1):
                at = phrases.starts(size)
                hashes = phrases.hashes(size, at)
                part = _part_of(hashes, parts)
                spots = _spots(part, hashes.astype(np.uint32)) & mask
                hit = bits[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1 == 1
                if len(kept) < parts:
                    hit &= (part >= kept.start) & (part < kept.stop)
                rows += [(lang, p, size, n) for lang, p, n in phrases.counted(size, at[hit], hashes[hit])]
            if rows:
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    counted = texts.mapInArrow(run, COUNTED)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame, threshold: int = 100, longest: int = 5, table_bytes: int | None = None
) -> DataFrame:
    """(lang, phrase, words, f): all phrases of (text, lang) with f >= threshold, and the
    words of each language as a null phrase of no words; a written table."""
    texts = docs.select("text", F.col("lang").cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    found = materialise(candidates(summaries(texts, longest, parts), threshold), "phrase-candidates")
    number = found.count()
    # sixteen bits a candidate, as far as there is room; two at least, by further rounds
    room = 1 << (8 * (table_bytes or broadcast_limit(docs.sparkSession))).bit_length() - 1
    bits = min(room, 1 << max(15, (16 * number).bit_length()))
    rounds = min(parts, max(1, -(-2 * number // bits)))
    out = []
    for turn in range(rounds):
        kept = range(parts * turn // rounds, parts * (turn + 1) // rounds)
        here = found.filter((F.col("part") >= kept.start) & (F.col("part") < kept.stop))
        counted = exact_counts(texts, longest, parts, kept, _table(here, bits))
        enough = counted.filter((F.col("f") >= threshold) | (F.col("words") == 0))
        out.append(materialise(enough, "phrase-counts"))
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]


def _words(at, size=None):
    """Words of the phrase from ``at`` (from 1) on, joined."""
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, at, F.col("words") if size is None else size), " ")


def weakest_cuts(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score): the lowest-scoring cut of each phrase in
    two, ties to the first; products are exact."""
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    one = F.lit(1)
    cut = cut.withColumns({"first": _words(one, F.col("k")), "rest": _words(F.col("k") + 1)})
    for side, f in (("first", "l"), ("rest", "r")):
        known = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
        cut = cut.join(broadcast_if_small(known), ["lang", side])
    cut = cut.join(broadcast_if_small(totals), "lang")
    whole = "decimal(20,0)"
    a, n, left, right = (F.col(c).cast(whole) for c in ("a", "n", "l", "r"))
    above = ((a * n).cast("decimal(38,0)") * 1000).cast("decimal(38,0)")
    score = F.call_function("div", above, (left * right).cast("decimal(38,0)")).cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("c")
    return cut.groupBy("lang", "phrase", "words", "a").agg(lowest).select(
        "lang", "phrase", "words", "a", "c.l", "c.r", "c.n", "c.score"
    )


def outside_longer(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases that do not lie in a longer one just as frequent. Counts fall with length,
    so if there is any, there is one that is longer by a word."""
    ends = F.explode(F.array(_words(F.lit(1), F.col("words") - 1), _words(F.lit(2))))
    longer = phrases.filter("words > 2").select("lang", ends.alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    joined = scored.join(broadcast_if_small(materialise(longer, "longer")), ["lang", "phrase"], "left")
    return joined.filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")


def collocations(
    docs: DataFrame, threshold: int = 100, longest: int = 5, top: int = 2000, table_bytes: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, words, a, l, r, n, score): the best phrases of two and more
    words of each language.

    With n words in all, a phrase that occurs a times and the occurrences l and r of its
    two parts, a cut has the score floor(1000 * a * n / (l * r)). Best score first, then
    the more frequent phrase, then by bytes.
    """
    found = frequent_phrases(docs, threshold, longest, table_bytes)
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    counts = found.filter("words > 0")
    phrases = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    scored = materialise(weakest_cuts(phrases, counts, totals), "cuts")
    left = outside_longer(scored, phrases)
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")
