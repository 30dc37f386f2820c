"""Compound words: adjacent words that the corpus often puts together."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.blocks import successors, token_blocks, valid_tokens
from docquarry.operators.corpus import drop_stopwords, keep_valid, tokenise, words
from docquarry.operators.joins import broadcast_if_small, fits, lookup
from docquarry.sources.shared import materialise


def token_arrays(
    cleaned: DataFrame, lexicon: DataFrame | None = None, stopwords: DataFrame | None = None
) -> DataFrame:
    """(doc_id, tokens) of cleaned texts (doc_id, text): the steps that an index and the
    questions asked of it share."""
    if lexicon is not None:
        return token_arrays_of(words(cleaned), lexicon, stopwords)
    tokens = tokenise(cleaned)
    return tokens if stopwords is None else drop_stopwords(tokens, stopwords)


def token_arrays_of(
    words: DataFrame, lexicon: DataFrame | None = None, stopwords: DataFrame | None = None
) -> DataFrame:
    """The same of all words (doc_id, tokens) of the cleaned texts."""
    tokens = keep_valid(words) if lexicon is None else join_compounds(words, lexicon, only_valid=True)
    return tokens if stopwords is None else drop_stopwords(tokens, stopwords)


def _pairs(words: DataFrame) -> DataFrame:
    """(doc_id, pos, t1, t2): every word with its successor, null at the end."""
    successors = F.slice("tokens", 2, F.size("tokens"))
    pair = F.arrays_zip(F.col("tokens").alias("t1"), successors.alias("t2"))
    rows = words.select("doc_id", F.posexplode_outer(pair).alias("pos", "pair"))
    return rows.select("doc_id", "pos", "pair.t1", "pair.t2")


CODE_BITS = 32
MARK_BITS = 22  # of a code, that mark the frequent ones
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _pair_codes():
    """A function from a block to the places of its pairs and a short hash of each."""
    adjacent = successors()
    one, two = map(np.uint64, FACTORS)

    def codes(sizes, numbers, words):
        hashes = np.array([crc32(word) for word in words.cast(pa.binary()).to_pylist()], np.uint64)
        at = np.flatnonzero(adjacent(sizes, numbers))
        mixed = (hashes * one)[numbers[at]] ^ (hashes * two)[numbers[at + 1]]
        return at, (mixed >> np.uint64(64 - CODE_BITS)).astype(np.uint32)

    return codes


def _frequent_codes(words: DataFrame, min_count: int, slots: int) -> DataFrame:
    """(code): hashes of pairs seen as often. A block's hashes are counted and go out as
    sorted arrays, one for each of ``slots`` ranges, which are added up by range."""
    blocks, pair_codes = token_blocks(), _pair_codes()
    cuts = np.arange(1, slots, dtype=np.uint64) * (1 << CODE_BITS) // slots

    def run(batches):
        for _, sizes, numbers, found in blocks(batches):
            codes, n = np.unique(pair_codes(sizes, numbers, found)[1], return_counts=True)
            at = np.searchsorted(codes, cuts.astype(np.uint32))
            parts = list(zip(np.split(codes, at), np.split(n.astype(np.uint32), at)))
            held = [i for i, (part, _) in enumerate(parts) if len(part)]
            columns = [pa.array(held, pa.int32())]
            columns += [pa.array([parts[i][k].tobytes() for i in held], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "codes", "n"])

    def add_up(table):
        codes, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint32) for c in ("codes", "n"))
        order = np.argsort(codes)
        codes = codes[order]
        starts = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ 1))
        sums = np.add.reduceat(n[order], starts, dtype=np.int64)
        return pa.table({"code": codes[starts][sums >= min_count].view(np.int32)})

    parts = words.select("tokens").mapInArrow(run, "slot int, codes binary, n binary")
    return parts.groupBy("slot").applyInArrow(add_up, "code int")


def _marked_pairs(words: DataFrame, marks: np.ndarray) -> DataFrame:
    """(code, t1, t2, n): the pairs whose hash starts like a frequent one, in parts of a block."""
    blocks, pair_codes = token_blocks(), _pair_codes()

    def run(batches):
        marked = np.zeros(1 << MARK_BITS, bool)
        marked[marks] = True
        for _, sizes, numbers, found in blocks(batches):
            at, codes = pair_codes(sizes, numbers, found)
            chosen = marked[codes >> np.uint32(CODE_BITS - MARK_BITS)]
            at, codes = at[chosen], codes[chosen]
            pairs, first, n = np.unique(
                numbers[at] * len(found) + numbers[at + 1], return_index=True, return_counts=True
            )
            t1, t2 = (found.take(pa.array(x)) for x in np.divmod(pairs, max(1, len(found))))
            columns = [pa.array(codes[first].view(np.int32)), t1, t2, pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["code", "t1", "t2", "n"])

    return words.select("tokens").mapInArrow(run, "code int, t1 string, t2 string, n long")


def learn_lexicon(
    words: DataFrame, min_count: int, again: DataFrame | None = None, slots: int | None = None
) -> DataFrame:
    """(t1, t2, n): adjacent word pairs seen at least ``min_count`` times.

    Pairs are counted by a short hash first, in ``slots`` ranges of it (by default as many as
    there are shuffle partitions), each of which a task holds at a time. Only those whose hash is as frequent, all
    frequent ones among them, are then counted as words, so that the many rare pairs are
    not shuffled as texts. Both counts are added up by block of documents before they become
    rows; in the second, the first bits of the frequent hashes, of bounded number, spare
    most other pairs from becoming any. It holds few groups: it may read the same words
    from ``again``, in tasks of any size, if ``words`` had to be shuffled.
    """
    slots = slots or int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = materialise(_frequent_codes(words, min_count, slots), "frequent-codes")
    starts = F.shiftrightunsigned("code", CODE_BITS - MARK_BITS).alias("start")
    marks = often.select(starts).distinct().toArrow().column("start").to_numpy()
    pairs = _marked_pairs(words if again is None else again, marks)
    pairs = pairs.join(broadcast_if_small(often), "code", "left_semi")
    counted = pairs.groupBy("t1", "t2").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _found(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, places): where a word and its successor are in the lexicon."""
    pairs = _pairs(words).filter(F.col("t2").isNotNull())
    hits = lookup(pairs, lexicon, ["t1", "t2"], weight="n")
    return hits.groupBy("doc_id").agg(F.sort_array(F.collect_list("pos")).alias("places"))


def _joined(rows: DataFrame) -> DataFrame:
    """(doc_id, tokens) of words and the places found among them."""
    before = lambda i: F.coalesce(F.get("places", i - 1), F.lit(-1))
    ones = F.transform("places", lambda p, i: F.concat(F.repeat(F.lit("0"), p - before(i) - 1), F.lit("1")))
    flags = F.rpad(F.array_join(ones, ""), F.size("tokens"), F.lit("0"))
    # S starts a compound, T is its second word, whatever it starts itself
    marks = F.split(F.regexp_replace(flags, "1.", "ST"), "")
    parts = F.arrays_zip(
        F.col("tokens").alias("t1"),
        F.slice("tokens", 2, F.size("tokens")).alias("t2"),
        F.slice(marks, 1, F.size("tokens")).alias("mark"),
    )
    both = lambda p: F.concat_ws("_", p["t1"], p["t2"])
    chosen = F.transform(parts, lambda p: F.when(p["mark"] == "S", both(p)).when(p["mark"] == "0", p["t1"]))
    chosen = F.filter(chosen, lambda token: token.isNotNull())
    tokens = F.when(F.col("places").isNull(), F.col("tokens")).otherwise(chosen)
    return rows.select("doc_id", F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))


def _join_in_place(words: DataFrame, lexicon: DataFrame, only_valid: bool) -> DataFrame:
    """Join the pairs of a lexicon that may be broadcast, a block of documents at a time."""
    pairs = lexicon.select("t1", "t2").dropna().distinct().toArrow()
    known = pc.unique(pa.chunked_array([*pairs.column("t1").chunks, *pairs.column("t2").chunks], pa.string()))
    first, second = (pc.index_in(pairs.column(c), value_set=known).to_numpy().astype(np.int64) for c in ("t1", "t2"))
    listed = np.sort(first * len(known) + second)
    blocks, adjacent, valid = token_blocks(), successors(), valid_tokens()

    def run(batches):
        for rows, sizes, numbers, found in blocks(batches):
            place = pc.fill_null(pc.index_in(found, value_set=known), -1)
            place = np.append(place.to_numpy(zero_copy_only=False).astype(np.int64), -1)[numbers]
            at = np.flatnonzero(adjacent(sizes, place))
            asked = place[at] * len(known) + place[at + 1]
            at = at[listed[np.minimum(np.searchsorted(listed, asked), len(listed) - 1)] == asked] if len(at) else at
            # of a run of neighbouring places every other one starts a compound
            opens = np.diff(at, prepend=-2) != 1
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
            kept = np.ones(len(numbers), bool)
            kept[at + 1] = False
            made, own = np.unique(numbers[at] * len(found) + numbers[at + 1], return_inverse=True)
            t1, t2 = (found.take(pa.array(x)) for x in np.divmod(made, max(1, len(found))))
            chosen = numbers.copy()
            chosen[at] = len(found) + own
            values = pa.concat_arrays([found, pc.binary_join_element_wise(t1, t2, "_")])
            if only_valid:
                kept &= np.append(valid(values), False)[chosen]
            chosen = chosen[kept]
            tokens = values.take(pa.array(chosen, mask=chosen < 0))
            cuts = np.append(0, np.cumsum(kept))[np.append(0, np.cumsum(sizes))]
            tokens = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), tokens)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), tokens], ["doc_id", "tokens"])

    made = T.StructField("tokens", T.ArrayType(T.StringType()))
    return words.select("doc_id", "tokens").mapInArrow(run, T.StructType([words.schema["doc_id"], made]))


def join_compounds(words: DataFrame, lexicon: DataFrame, only_valid: bool = False) -> DataFrame:
    """Join lexicon pairs by '_', left to right without overlap; with ``only_valid``, keep the
    valid ones of the tokens that come out.

    A lexicon under the broadcast limit goes to the documents, which stay where they are;
    in a run of neighbouring places found there, every other one starts a compound.

    With a larger one, a document's words are marked as a text of 0 and 1 (the word and its
    successor are in the lexicon); the greedy scan from the left is a pattern on it. Rows are
    made of the pairs that are looked up, and only the places of those found are grouped.
    ``words`` should have one row per ``doc_id``; they are written first and every branch of
    the join reads them.
    """
    if fits(lexicon):
        return _join_in_place(words, lexicon, only_valid)
    words = materialise(words, "words")
    # an id of null meets no other in a join; such a row stands for itself
    unnamed = words.filter(F.col("doc_id").isNull())
    words = words.filter(F.col("doc_id").isNotNull())
    found = _found(words, lexicon).withColumnRenamed("doc_id", "found_id")
    named = words.join(found, F.col("doc_id") == F.col("found_id"), "left")
    alone = unnamed.crossJoin(_found(unnamed, lexicon).select("places")) if not unnamed.isEmpty() else None
    rows = named.select("doc_id", "tokens", "places")
    joined = _joined(rows if alone is None else rows.unionByName(alone))
    return keep_valid(joined) if only_valid else joined
