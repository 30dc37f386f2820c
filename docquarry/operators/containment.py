"""Which documents contain which passages, without a row for every run of words.

Any text with a passage holds the runs of three words inside the passage as well (of fewer
for a short one; runs of characters, if it has no inner word). The asked runs are marked in
a bit table of bounded size, a constant of the plan; the runs of a text are tested inside
its array, and only those with their bit set become rows. The rarest run of a passage is
then an equi-join key that misses nothing, and what it finds is checked against the texts.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.operators.joins import broadcast_if_small, broadcast_limit
from docquarry.sources.shared import materialise

WORD_GRAM = 3
CHARACTER_GRAM = 5
BITS_PER_GRAM = 64
MOST_BITS = 1 << 23
ROW_BYTES = 160  # of a passage besides its text
NAMED = 200  # short passages whose beginnings a pattern names


def _characters(text: str) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _gram_keys(pieces: Column, kind: str, size: int) -> Column:
    """Hashes of all runs of ``size`` pieces."""
    if size == 0:
        return F.array(F.xxhash64(F.lit(kind), F.lit(0)))
    last = F.size(pieces) - size
    run = lambda i: F.xxhash64(F.lit(kind), F.lit(size), *[F.get(pieces, i + j) for j in range(size)])
    runs = F.transform(F.sequence(F.lit(0), last), run)
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def _asked_grams(passages: DataFrame, keys: list[str], found: list) -> DataFrame:
    """(keys, gram): runs that any text with the passage holds as well.

    The inner words of a passage are whole words of the text. A passage without inner
    words gives its first characters.
    """
    rows = []
    for kind, size in found:
        of_kind = passages.filter((F.col("kind") == kind) & (F.col("size") == size))
        words = F.split("question", " ")
        inner = F.slice(words, 2, F.size(words) - 2)
        first = F.slice(_characters("question"), 1, size)
        of_kind = of_kind.withColumn("pieces", inner if kind == "words" else first)
        rows.append(of_kind.select(*keys, F.explode(_gram_keys(F.col("pieces"), kind, size)).alias("gram")))
    return reduce(DataFrame.unionByName, rows).distinct()


class BitTable:
    """A set of hashes as a constant array of 64-bit words. It has BITS_PER_GRAM bits for
    each hash, at most MOST_BITS; beyond that, more hashes pass that were never asked for."""

    def __init__(self, grams: DataFrame):
        place = F.pmod("gram", F.lit(MOST_BITS))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        words = grams.groupBy(F.floor(place / 64).cast("int").alias("word")).agg(
            F.bit_or(bit).alias("set"), F.count("*").alias("n")
        )
        rows = words.collect()  # at most a row for 64 bits of the largest table
        total = sum(row.n for row in rows)
        self.bits = 64
        while self.bits < min(MOST_BITS, BITS_PER_GRAM * total):
            self.bits *= 2
        held = [0] * (self.bits // 64)
        for row in rows:  # a power of two: the larger table folds into the smaller one
            held[row.word % len(held)] |= row.set
        self.words = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def has(self, gram: Column) -> Column:
        place = F.pmod(gram, F.lit(self.bits))
        word = F.get(self.words, F.call_function("shiftright", place, F.lit(6)).cast("int"))
        inside = place.bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftright", word, inside).bitwiseAND(F.lit(1)) == 1


def _beginnings(passages: DataFrame) -> str | None:
    """A pattern of what passages without inner words begin with; None for very many."""
    short = passages.filter((F.col("kind") == "characters") & (F.col("size") > 0))
    named = short.select(F.substring("question", 1, CHARACTER_GRAM).alias("start")).distinct()
    starts = [row.start for row in named.limit(NAMED + 1).collect()]
    return "|".join(map(re.escape, starts)) if len(starts) <= NAMED else None


def containing(passages: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, doc_id): documents (doc_id, text) whose text contains the whole passage of
    ``passages`` (keys, question).

    A null passage is in no text, an empty one in all texts but null ones.
    """
    inner = F.size(F.split("question", " ")) - 2
    passages = passages.filter(F.col("question").isNotNull()).select(*keys, "question")
    passages = passages.withColumns(
        {
            "kind": F.when(inner > 0, "words").otherwise("characters"),
            "size": F.when(inner > 0, F.least(inner, F.lit(WORD_GRAM))).otherwise(
                F.least(F.length("question"), F.lit(CHARACTER_GRAM))
            ),
        }
    )
    rows = passages.groupBy("kind", "size").agg(F.count("*").alias("n"), F.sum(F.octet_length("question")).alias("b"))
    rows = rows.collect()  # a row for each length of a short passage
    kinds = sorted((row.kind, row.size) for row in rows)
    if not kinds:
        return passages.select(*keys, F.lit(0).cast("long").alias("doc_id"))
    grams = materialise(_asked_grams(passages, keys, kinds), "asked-runs")
    small = sum(row.b + ROW_BYTES * row.n for row in rows) <= broadcast_limit(docs.sparkSession)
    own = F.broadcast if small else lambda rows: rows
    table = BitTable(grams)
    texts = docs.filter(F.col("text").isNotNull())
    held = []
    for kind, size in kinds:
        wanted = texts
        if kind == "characters" and size and (pattern := _beginnings(passages)) is not None:
            wanted = texts.filter(F.col("text").rlike(pattern))  # no other text has characters to look at
        pieces = F.split("text", " ") if kind == "words" else _characters("text")
        runs = wanted.select("doc_id", pieces.alias("pieces"))
        marked = F.filter(_gram_keys(F.col("pieces"), kind, size), table.has)
        held.append(runs.select("doc_id", F.explode(F.array_distinct(marked)).alias("gram")))
    # one pass over the texts for each kind; which runs are rare shows afterwards
    held = materialise(reduce(DataFrame.unionByName, held), "run-hits")
    counts = held.groupBy("gram").agg(F.count("*").alias("n"))
    counts = counts.join(own(grams.select("gram").distinct()), "gram", "left_semi")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).getField("gram")
    anchors = grams.join(counts, "gram", "left").groupBy(*keys).agg(rarest.alias("gram"))
    # texts stay out of the join by gram; those it finds are looked up afterwards
    pairs = materialise(held.join(own(anchors), "gram").select(*keys, "doc_id"), "pairs")
    candidates = documents_of(pairs, texts).join(pairs, "doc_id")
    found = candidates.join(own(passages.select(*keys, "question")), keys)
    return found.filter(F.col("text").contains(F.col("question"))).select(*keys, "doc_id").distinct()


def documents_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text) that ``pairs`` names."""
    ids = broadcast_if_small(pairs.select("doc_id").distinct())
    return docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
