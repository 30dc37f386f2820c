"""The best k documents of every question without scoring all that match.

MaxScore by length class. The index keeps, for each frequent term and class of document
lengths, the largest share that the term has in a document (``bounds``). From it:

1. seeds: documents with a question's rarest words are scored; the k-th best score is one
   that every result must reach;
2. in each length class, the terms whose bounds, added up from the smallest, stay below a
   share of that score are resting; documents with resting terms only cannot be results,
   and postings of resting terms are not looked at;
3. the other terms' scores are added up per document; what its resting terms could add at
   most decides whether it can still be a result. The best of these are scored in full,
   which raises the score to reach; then all that can still reach it.

Documents are scored in full by the expressions of a plain ranking, so rows and ties are
the same. Scores are compared with a margin for their rounding. Questions with fewer than
k documents have no score to reach and no resting terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import weights
from docquarry.functions.fixed import METHOD_BM25, METHOD_TFIDF
from docquarry.operators.joins import broadcast_if_small
from docquarry.operators.postings import length_class
from docquarry.operators.ranking import matches, scores_of, sums, top_k
from docquarry.sources.index_store import Index
from docquarry.sources.shared import materialise

CARRIED = ("doc_id", "term", "tf", "dl")
MARGIN = 2e-6  # of two scores rounded to six digits
RESTING_SHARE = 0.4  # of the score to reach that resting terms may add up to
SEEDS = 4  # documents with rare words, per result
MOST_BROADCAST = 20  # results a question whose documents are fewer than a question's terms


@dataclass(frozen=True)
class Bounded:
    """A batch of questions over an index; ``question`` is the struct of their keys."""

    index: Index
    vectors: DataFrame
    small: bool
    k: int
    methods: tuple[str, ...]
    query_tf: str
    k1: float
    b: float

    def summed(self, hits: DataFrame, *extra: Column) -> DataFrame:
        """(question, doc_id, one column per method) of rows of question terms."""
        return sums(self.index, hits, ["question"], self.small, self.methods, self.query_tf, self.k1, self.b, *extra)

    def per_question(self, rows: DataFrame) -> DataFrame:
        """A few rows a question: broadcast wherever the question vectors are."""
        return F.broadcast(rows) if self.small else rows

    def scored(self, pairs: DataFrame) -> DataFrame:
        """(method, question, doc_id, score) of the pairs (question, doc_id, methods)."""
        hits = self.index.postings.select(*CARRIED).join(pairs, "doc_id")
        hits = hits.join(self.per_question(self.vectors), ["question", "term"])
        wide = self.summed(hits, F.first("methods").alias("methods"))
        rows = scores_of(wide, ["question", "methods"], self.methods)
        return rows.filter(F.array_contains("methods", F.col("method"))).drop("methods")

    def to_reach(self, scores: DataFrame) -> DataFrame:
        """(question, one column per method): the k-th best score, null if there is none."""
        best = top_k(scores, ["method", "question"], self.k).filter(F.col("rank") == self.k)
        wide = [F.max(F.when(F.col("method") == m, F.col("score"))).alias(f"reach_{m}") for m in self.methods]
        return best.groupBy("question").agg(*wide)

    def best_by(self, rows: DataFrame) -> DataFrame:
        """(question, doc_id, methods): the k best by their sums so far, for each method."""
        rows = scores_of(rows, ["question"], self.methods)
        best = top_k(rows, ["method", "question"], self.k)
        found = best.groupBy("question", "doc_id").agg(F.collect_set("method").alias("methods"))
        return self.per_question(found) if self.k <= MOST_BROADCAST else found

    def seeds(self) -> DataFrame:
        """The k best documents by a question's rarest words, as many words as it takes."""
        rarest = Window.partitionBy("question").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("df").over(rarest), F.lit(0))
        few = self.vectors.withColumn("before", before).filter(F.col("before") < SEEDS * self.k).drop("before")
        return self.best_by(self.summed(matches(self.index, few, ["question"], self.small, CARRIED)))

    def limits(self) -> DataFrame:
        """(question, term, class, one column per method): the most that a term can add."""
        avgdl = self.index.scalar("avgdl")
        bm25 = weights.bm25_weight(F.col("max_tf"), F.col("min_dl"), avgdl, F.col("bm25_idf"), self.k1, self.b)
        if self.query_tf == "multiplicity":
            bm25 = bm25 * F.col("qtf")
        most = {METHOD_BM25: bm25, METHOD_TFIDF: F.col("qw") * F.col("idf") * F.col("max_share") / F.col("q_norm")}
        vectors = self.vectors.select("question", "term", "qtf", "idf", "bm25_idf", "qw", "q_norm")
        held = self.index.bounds.join(F.broadcast(vectors) if self.small else vectors, "term")
        return held.select("question", "term", "class", *[most[m].alias(f"most_{m}") for m in self.methods])

    def resting(self, reach: DataFrame) -> DataFrame:
        """(question, term, class, limits): terms that rest in documents of the class."""
        limits = self.limits().join(self.per_question(reach), "question")
        rests = F.lit(True)
        for method in self.methods:
            most, least = F.col(f"most_{method}"), F.col(f"reach_{method}")
            ascending = Window.partitionBy("question", "class").orderBy(most, "term")
            low = F.sum(most).over(ascending.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            rests = rests & F.coalesce(low + MARGIN < RESTING_SHARE * least, F.lit(False))
        return limits.withColumn("rests", rests).filter("rests").drop("rests", *reach.columns[1:])


def best(
    index: Index,
    vectors: DataFrame,
    keys: list[str],
    small: bool,
    k: int,
    methods: tuple[str, ...],
    query_tf: str,
    k1: float,
    b: float,
) -> DataFrame:
    """(method, keys, rank, doc_id, score) of the best k documents per question."""
    asked = vectors.withColumn("question", F.struct(*keys)).drop(*keys)
    asked = materialise(asked, "question-vectors")
    batch = Bounded(index, asked, small, k, methods, query_tf, k1, b)
    reach = materialise(batch.to_reach(batch.scored(batch.seeds())), "scores-to-reach")
    resting = materialise(batch.resting(reach), "resting-terms")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("class")))
    masks = resting.groupBy("question", "term").agg(bits.alias("resting"))
    awake = asked.join(batch.per_question(masks), ["question", "term"], "left")
    awake = awake.withColumn("resting", F.coalesce("resting", F.lit(0).cast("long")))
    hits = matches(index, awake, ["question"], small, CARRIED).withColumn("class", length_class(F.col("dl")))
    hits = hits.filter(F.call_function("shiftright", "resting", "class").bitwiseAND(F.lit(1)) == 0)
    room = resting.groupBy("question", "class").agg(
        *[F.sum(f"most_{m}").alias(f"more_{m}") for m in methods]
    )
    partial = batch.summed(hits, F.first("class").alias("class"))
    partial = partial.join(broadcast_if_small(room), ["question", "class"], "left")

    def reachable(reach: DataFrame) -> Column:
        """The methods by which a document can still be a result."""
        able = []
        for m in methods:
            most = F.col(m) + F.coalesce(f"more_{m}", F.lit(0.0)) + MARGIN
            enough = F.coalesce(most >= F.col(f"reach_{m}"), F.lit(True))
            able.append(F.when(enough, F.lit(m)))
        return F.array_compact(F.array(*able))

    def left(rows: DataFrame, reach: DataFrame) -> DataFrame:
        joined = rows.join(batch.per_question(reach), "question", "left")
        kept = joined.withColumn("methods", reachable(reach)).filter(F.size("methods") > 0)
        return kept.drop(*reach.columns[1:])

    open_ = materialise(left(partial, reach).drop("methods"), "open-pairs")
    higher = batch.to_reach(batch.scored(batch.best_by(open_)))
    both = reach.unionByName(higher).groupBy("question").agg(*[F.max(c).alias(c) for c in reach.columns[1:]])
    both = materialise(both, "scores-to-reach")
    pairs = materialise(left(open_, both).select("question", "doc_id", "methods"), "scored-pairs")
    scores = batch.scored(broadcast_if_small(pairs))
    top = top_k(scores, ["method", "question"], k)
    return top.select("method", "question.*", "rank", "doc_id", "score")
