"""Toxicity by the nearest labelled examples, with block-max inverted indexes.

Texts become TF-IDF vectors over the whole vocabulary of the labelled examples (only terms
of a single labelled row are left out). No term is cut for saying little; how much it says
is part of its weight: idf times ``floor`` plus the squared correlation (phi) of its
presence with the label, over all labelled rows. That is between 0 and 1 whatever the
number of rows and the share of toxic ones. (By idf alone, the nearest rows to a long text
are those of its subject.) The examples stand in an inverted index whose postings are cut
into blocks of examples with the largest weight of each term in each block. For a text, the
blocks' upper bounds order them, and blocks that cannot hold one of the k nearest are never
opened; where most could, all postings of the text's terms are added up in one go, those of
the most frequent terms as a product over several texts. The k nearest are exact either way. They vote with a weight that falls with distance; the votes,
smoothed with the prior, are the score, and the neighbours are the evidence.

Term statistics are counted over all labelled rows. The examples are a bounded sample
of them (about ``examples`` per class at most, chosen by a hash of id and text, so that
copies are not drawn together), and each votes for as many rows as it stands for.

Defined results: a text without a term of the examples (null and empty texts too) has no
neighbours and scores the smoothed share of toxic rows among labelled texts of that
kind; without labelled rows every score is 0.0; equal similarities go to the smaller
example id; rows that repeat id and text are one example; a row labelled
twice counts as toxic if any label says so; null labels are ignored; further columns
are carried along, those named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.joins import broadcast_if_small

WORD = re.compile(r"[^\W\d_]+")
BLOCK = 64
OPENED = 4  # blocks opened before the others' bounds are looked at
# If, by the common terms alone, a quarter of the blocks have bounds above this share of the
# largest one, hardly any block could be left shut, and all postings are added up at once.
FLAT = 0.4
COMMON = 32  # a term of more than one example in so many is common
DENSE = 256  # most frequent terms, whose weights also stand in a table of all examples
TOGETHER = 256  # texts whose most frequent terms are added up in one product
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,toxic:int>>"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _spans(at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each ``at`` to before its ``end``, one after the other."""
    sizes = end - at
    before = np.cumsum(sizes) - sizes
    return np.repeat(at - before, sizes) + np.arange(sizes.sum())


def _kth(sums: np.ndarray, k: int) -> float:
    """The k-th largest."""
    return np.partition(sums, -k)[-k] if len(sums) > k else 0.0


@dataclass
class Index:
    """Postings by term, examples ascending; ``blocks`` lists a term's blocks."""

    terms: dict[str, int]
    gain: np.ndarray  # weight of each term: its idf, times what it says on the label
    starts: np.ndarray  # of each term's blocks
    blocks: np.ndarray  # block number of each (term, block)
    most: np.ndarray  # its largest weight
    cuts: np.ndarray  # where its postings start; one more at the end
    rows: np.ndarray  # example of each posting
    weights: np.ndarray
    ids: np.ndarray  # of each example
    toxic: np.ndarray
    stands_for: np.ndarray
    prior: float  # share of toxic rows
    bare: float  # the same among texts without any term

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms and unit-length weights of a text."""
        known = Counter(map(self.terms.get, words(text)))
        known.pop(None, None)
        if not known:
            return np.empty(0, np.int64), np.empty(0)
        terms = np.fromiter(known, np.int64, len(known))
        order = np.argsort(terms)
        terms = terms[order]
        tf = np.fromiter(known.values(), np.float64, len(known))[order]
        weights = (1 + np.log(tf)) * self.gain[terms]
        return terms, weights / np.sqrt(weights @ weights)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int):
        """Examples and cosines of the k nearest, exact."""
        return self.nearest_each([(terms, weights)], k)[0]

    def nearest_each(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list:
        """``nearest`` of several texts; those that blocks do not help share a product."""
        found = [self._by_blocks(terms, weights, k) for terms, weights in vectors]
        rest = [i for i, f in enumerate(found) if f is None]
        for start in range(0, len(rest), TOGETHER):
            part = rest[start : start + TOGETHER]
            for i, answer in zip(part, self._by_all([vectors[i] for i in part], k)):
                found[i] = answer
        return found

    def _by_blocks(self, terms: np.ndarray, weights: np.ndarray, k: int):
        """The k nearest from the blocks that can hold one; None where most blocks can."""
        if self._flat(terms, weights):
            return None
        first, last = self.starts[terms], self.starts[terms + 1]
        entry = _spans(first, last)
        if not len(entry):
            return np.empty(0, np.int64), np.empty(0)
        share, block, n = np.repeat(weights, last - first), self.blocks[entry], len(self.ids)
        bounds = np.bincount(block, share * self.most[entry], minlength=n // BLOCK + 1)

        def opened(which):
            own = np.flatnonzero(which[block])
            at, end = self.cuts[entry[own]], self.cuts[entry[own] + 1]
            postings = _spans(at, end)
            parts = np.repeat(share[own], end - at) * self.weights[postings]
            return np.bincount(self.rows[postings], parts, minlength=n)

        now = np.zeros(len(bounds), bool)
        now[np.argsort(-bounds, kind="stable")[:OPENED]] = True
        sums = opened(now)
        more = (bounds > 0) & (bounds >= _kth(sums, k) - 1e-9) & ~now
        if 4 * more.sum() > len(bounds):
            return None
        if more.any():
            sums += opened(more)
        rows = np.flatnonzero((sums > 0) & (sums >= _kth(sums, k) - 1e-9))
        return self._best(rows, sums[rows], k)

    def _by_all(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int):
        """The k nearest from all postings: the most frequent terms of all ``vectors`` in one
        product in single precision, whose error is bounded, the others by their postings.
        What can be among the k nearest is added up again in double precision."""
        place, dense, single = self._dense
        asked = np.zeros((len(vectors), dense.shape[1]))
        rare = []
        for row, (terms, weights) in zip(asked, vectors):
            at = place[terms]
            own = at >= 0
            row[at[own]] = weights[own]
            rare.append((terms[~own], weights[~own]))
        margin = (2 * dense.shape[1] + 16) * 2.0**-24  # both vectors have a length of 1 at most
        for row, (terms, weights), rough in zip(asked, rare, asked.astype(np.float32) @ single.T):
            sums = self._all(terms, weights)
            rough += sums
            near = np.flatnonzero((rough > 0) & (rough >= _kth(rough, k) - 2 * margin))
            yield self._best(near, (dense[near] * row).sum(1) + sums[near], k)

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.ids[rows].astype(np.int64), -np.round(scores, 12)))[:k]
        return rows[best], np.minimum(scores[best], 1.0)

    @cached_property
    def _common(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of each common term (-1: not common) and its largest weight in each block."""
        df = self.cuts[self.starts[1:]] - self.cuts[self.starts[:-1]]
        common = np.flatnonzero(df > len(self.ids) / COMMON)
        place = np.full(len(df), -1)
        place[common] = np.arange(len(common))
        most = np.zeros((len(common), len(self.ids) // BLOCK + 1))
        for row, term in enumerate(common):
            entries = slice(self.starts[term], self.starts[term + 1])
            most[row, self.blocks[entries]] = self.most[entries]
        return place, most

    def _flat(self, terms: np.ndarray, weights: np.ndarray) -> bool:
        """Whether block bounds differ too little to shut blocks."""
        place, most = self._common
        at = place[terms]
        bounds = weights[at >= 0] @ most[at[at >= 0]]
        quarter = -(len(bounds) // 4) - 1
        return bool(np.partition(bounds, quarter)[quarter] > FLAT * bounds.max())

    @cached_property
    def _dense(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each of the most frequent terms (-1: not one), and all examples' weights of
        them, in double and in single precision."""
        df = self.cuts[self.starts[1:]] - self.cuts[self.starts[:-1]]
        frequent = np.argsort(-df, kind="stable")[:DENSE]
        place = np.full(len(df), -1)
        place[frequent] = np.arange(len(frequent))
        dense = np.zeros((len(self.ids), len(frequent)))
        for column, term in enumerate(frequent):
            entries = slice(self.cuts[self.starts[term]], self.cuts[self.starts[term + 1]])
            dense[self.rows[entries], column] = self.weights[entries]
        return place, dense, dense.astype(np.float32)

    def _all(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the terms add to the cosines with all examples."""
        at, end = self.cuts[self.starts[terms]], self.cuts[self.starts[terms + 1]]
        postings = _spans(at, end)
        parts = self.weights[postings] * np.repeat(weights, end - at)
        return np.bincount(self.rows[postings], parts, minlength=len(self.ids))

    def score(self, rows: np.ndarray, cosines: np.ndarray, smoothing: float = 1.0) -> float:
        """Votes of the neighbours, weighted by closeness; a close one counts most."""
        if not len(rows):
            return self.bare
        votes = cosines**2 / (1.0001 - cosines**2) * self.stands_for[rows]
        votes /= 1 + votes  # a single neighbour weighs one at most
        toxic = votes @ self.toxic[rows] + smoothing * self.prior
        return float(toxic / (votes.sum() + smoothing))


def build(rows: list, terms: list, n_rows: int, n_toxic: int, stands_for: dict, bare: float) -> Index:
    """An index of examples (doc_id, toxic, {term: count}) over terms (term, df), by idf."""
    place = {row.term: i for i, row in enumerate(terms)}
    found = [(e, place[t], n) for e, row in enumerate(rows) for t, n in row.counts.items() if t in place]
    example, term, count = np.array(found, np.int64).reshape(-1, 3).T
    return arrange(
        place, idf(n_rows, np.array([row.df for row in terms], float)), example, term, count,
        np.array([row.doc_id for row in rows], object), np.array([float(row.toxic) for row in rows]),
        stands_for, n_toxic / n_rows if n_rows else 0.0, bare,
    )


def idf(n_rows: int, df: np.ndarray) -> np.ndarray:
    return np.log((1 + n_rows) / (1 + df)) + 1


def correlation(n_rows: int, n_toxic: int, df: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The squared correlation (phi) of terms in ``df`` rows, ``hits`` of them toxic, with
    the label; 0 where either does not vary."""
    prior = n_toxic / n_rows if n_rows else 0.0
    spread = df * prior * (1 - prior) * (n_rows - df)
    return np.where(spread > 0, (hits - prior * df) ** 2 / np.where(spread > 0, spread, 1.0), 0.0)


def arrange(terms, gain, example, term, count, ids, toxic, stands_for, prior, bare) -> Index:
    """An index of postings (example, term, count) given as arrays."""
    weight = (1 + np.log(count)) * gain[term]
    weight = weight / np.sqrt(np.bincount(example, weight * weight, minlength=len(ids)))[example]
    main = np.zeros(len(ids), np.int64)  # the heaviest term
    order = np.argsort(weight, kind="stable")
    main[example[order]] = term[order]
    sizes = np.bincount(example, minlength=len(ids))
    alike = np.lexsort((ids.astype(np.int64), sizes, main))  # alike ones share blocks
    place = np.empty(len(ids), np.int64)
    place[alike] = np.arange(len(ids))
    example = place[example]
    order = np.lexsort((example, term))
    term, row, weight = term[order].astype(np.int64), example[order], weight[order]
    pair = term * (len(ids) // BLOCK + 1) + row // BLOCK
    cuts = np.flatnonzero(np.r_[True, np.diff(pair) != 0]) if len(pair) else np.empty(0, np.int64)
    toxic = toxic[alike]
    return Index(
        terms=terms,
        gain=gain,
        starts=np.searchsorted(term[cuts], np.arange(len(terms) + 1)),
        blocks=row[cuts] // BLOCK,
        most=np.maximum.reduceat(weight, cuts) if len(cuts) else np.empty(0),
        cuts=np.r_[cuts, len(term)],
        rows=row.astype(np.int32),
        weights=weight,
        ids=ids[alike],
        toxic=toxic,
        stands_for=np.array([stands_for[int(t)] for t in toxic]),
        prior=prior,
        bare=bare,
    )


# ---------------------------------------------------------------- Spark


def _counted(labelled: DataFrame, known: frozenset) -> DataFrame:
    """(term, toxic, n): rows that hold a known term, summed up by every batch."""

    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                counts.update((w, toxic) for w in known.intersection(words(text.as_py())))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["term", "toxic", "n"],
            )

    return labelled.select("text", "toxic").mapInArrow(run, "term string, toxic int, n long")


def train(
    docs: DataFrame,
    labels: DataFrame,
    least_rows: int = 2,
    floor: float = 1e-3,
    examples: int = 5000,
) -> Index:
    """Learn from ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks."""
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    labelled = docs.select("doc_id", "text").join(broadcast_if_small(marks), "doc_id")
    labelled = labelled.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    totals = {row.toxic: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    n, n_toxic = sum(totals.values()), totals.get(1, 0)
    prior = n_toxic / n if n else 0.0
    fraction = {toxic: min(1.0, examples / count) for toxic, count in totals.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(1 << 20)) / float(1 << 20)
    limit = F.when(F.col("toxic") == 1, fraction.get(1, 1.0)).otherwise(fraction.get(0, 1.0))

    def vectors(batches):
        for batch in batches:
            found = [Counter(words(text.as_py())) for text in batch.column("text")]
            arrays = [
                batch.column("doc_id"),
                batch.column("toxic"),
                pa.array([list(f) for f in found], pa.list_(pa.string())),
                pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "toxic", "terms", "counts"])

    sample = labelled.filter(draw < limit).groupBy("doc_id", "toxic", "text").agg(F.count("*").alias("n"))
    rows = sample.mapInArrow(vectors, "doc_id long, toxic int, terms array<string>, counts array<int>").toArrow()
    rows = rows.combine_chunks()
    coded = pc.list_flatten(rows["terms"]).combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    names = coded.dictionary.to_pylist()
    by_term = _counted(labelled, frozenset(names)).groupBy("term").agg(
        F.sum("n").alias("df"), F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("hits")
    )
    chosen = by_term.filter(F.col("df") >= least_rows).toArrow().sort_by("term")
    df, hits = (chosen[c].to_numpy().astype(float) for c in ("df", "hits"))
    place = {term: i for i, term in enumerate(chosen["term"].to_pylist())}
    gain = idf(n, df) * (floor + correlation(n, n_toxic, df, hits))

    term = np.array([place.get(name, -1) for name in names], np.int64)[coded.indices.to_numpy()]
    example = pc.list_parent_indices(rows["terms"]).to_numpy().astype(np.int64)
    count = pc.list_flatten(rows["counts"]).to_numpy().astype(np.int64)
    known = term >= 0
    term, example, count = term[known], example[known], count[known]
    ids, toxic = rows["doc_id"].to_numpy(), rows["toxic"].to_numpy().astype(float)
    there = np.bincount(example, minlength=len(ids)) > 0
    stands_for = {toxic: 1 / share for toxic, share in fraction.items()}
    bare = [stands_for.get(t, 1.0) * float(np.sum(~there & (toxic == t))) for t in (0, 1)]
    bare_share = (bare[1] + prior) / (sum(bare) + 1)
    example = (np.cumsum(there) - 1)[example]
    return arrange(place, gain, example, term, count, ids[there], toxic[there], stands_for, prior, bare_share)


def score(docs: DataFrame, index: Index, k: int = 15) -> DataFrame:
    """``docs`` with score, predicted and evidence added; only the text is looked at."""
    docs = docs.drop("score", "predicted", "evidence")
    keep = 2000

    def run(batches):
        known: dict[bytes, tuple] = {}  # copies need one search
        for batch in batches:
            scores, evidence = [], []
            texts = batch.column(batch.schema.get_field_index("text"))
            for start in range(0, len(texts), TOGETHER):
                vectors = [index.vector(text.as_py()) for text in texts[start : start + TOGETHER]]
                keys = [blake2b(t.tobytes() + w.tobytes(), digest_size=16).digest() for t, w in vectors]
                if len(known) >= keep:
                    known.clear()
                new = {key: vector for key, vector in zip(keys, vectors) if key not in known}
                for key, (rows, cosines) in zip(new, index.nearest_each(list(new.values()), k)):
                    told = [
                        {"doc_id": index.ids[r], "similarity": float(c), "toxic": int(index.toxic[r])}
                        for r, c in zip(rows, cosines)
                    ]
                    known[key] = (index.score(rows, cosines), told)
                for key in keys:
                    value, told = known[key]
                    scores.append(value)
                    evidence.append(told)
            kind = pa.list_(
                pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])
            )
            added = [
                pa.array(scores, pa.float64()),
                pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array(evidence, kind),
            ]
            names = [*batch.schema.names, "score", "predicted", "evidence"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    added = T.StructType.fromDDL(f"score double, predicted int, evidence {EVIDENCE}")
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))
