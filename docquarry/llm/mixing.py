"""Mixing documents to target weights with soft domain membership, in DataFrame functions.

A naive Bayes classifier over hashed words, fitted on all labelled documents, gives every
document a posterior over the domains. With those, document i offers ``tokens_i * p_id``
expected tokens of domain d. Nonnegative document rates r_i are then fitted by projected-
gradient least squares, so that the expected tokens of every domain,
sum_i r_i * tokens_i * p_id, match its target.

A rate is max(0, posteriors . potentials), with one potential for each domain, all 1 at
first: of all rates that meet the targets these change documents the least, weighed by
tokens. In each round Spark adds up, in one aggregate, the domain totals and the Gram
matrix of the documents whose rate is not cut off at zero; the residual, measured in that
matrix, is the step of the potentials, and every document's rate moves along it and is
projected back to zero or more. A second aggregate tries shorter steps as well, and the one
that lowers the objective most is taken. The driver sees nothing but these sums, a few
numbers per domain; nothing is joined or shuffled, and the plan does not grow with the
rounds. Targets out of reach are met as well as least squares can; ``Fit`` says how well.

Evidence counts for ``strength`` (100) words of a text at most: naive Bayes takes words as
independent, and without a bound every long text would have a posterior of 0 or 1.

Defined results: a null or empty text has no tokens, posteriors equal to the priors and
rate 1; null labels say nothing, also beside another label that is given; a domain that
nothing is labelled with has no posterior and its target is left out; without any labelled
document there are no domains, posteriors are empty and every rate is 1; repeated rows are
rated each; further columns are carried along, those named tokens, posteriors or rate are
replaced, and one named _slots or _copy is dropped.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from functools import reduce
from math import log
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise

BUCKETS = 4096
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(text: str) -> Column:
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.filter(F.split(lowered, BLANKS), lambda w: w != "")


def _slots(words: Column) -> Column:
    """The hash bucket of each word."""
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


@dataclass
class Classifier:
    """Log priors of the domains, and log likelihoods of each by bucket."""

    domains: list[str] = field(default_factory=list)
    priors: list[float] = field(default_factory=list)
    likelihoods: list[np.ndarray] = field(default_factory=list)

    def posteriors(self, slots: str, strength: float) -> Column:
        """array<double> in the order of the domains. The mean log likelihood of a word
        counts ``strength`` times at most: words of one text are not independent."""
        weight = F.least(F.size(slots).cast("double"), F.lit(strength)) / F.greatest(
            F.size(slots), F.lit(1)
        )

        def evidence(table: np.ndarray) -> Column:
            text = ",".join(f"{value:.5f}" for value in table)
            values = F.split(F.lit(text), ",").cast("array<double>")  # folded to a constant
            return F.aggregate(slots, F.lit(0.0), lambda done, slot: done + F.get(values, slot))

        scores = [F.lit(p) + weight * evidence(t) for p, t in zip(self.priors, self.likelihoods)]
        if not scores:
            return F.array().cast("array<double>")
        raised = [F.exp(score - F.greatest(*scores, F.lit(-1e300))) for score in scores]
        return F.array(*[value / reduce(add, raised) for value in raised])


def train(labelled: DataFrame) -> Classifier:
    """Count the words of (text, domain) into buckets; all labelled rows count."""
    rows = labelled.filter(F.col("domain").isNotNull())
    slots = rows.select("domain", F.explode(_slots(words_of("text"))).alias("slot"))
    sizes = {row.domain: row["count"] for row in rows.groupBy("domain").count().collect()}
    counts = {domain: np.zeros(BUCKETS) for domain in sizes}
    for row in slots.groupBy("domain", "slot").count().collect():  # domains x buckets at most
        counts[row.domain][row.slot] = row["count"]
    total = sum(sizes.values())
    model = Classifier()
    for domain in sorted(counts):
        model.domains.append(domain)
        model.priors.append(log(sizes[domain] / total))
        model.likelihoods.append(np.log((counts[domain] + 1) / (counts[domain].sum() + BUCKETS)))
    return model


def label_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, domain) of the labelled documents: ``low`` quality, ``toxic``, or ``good``,
    where a label that is null says nothing and one of the two is enough."""
    low, toxic = F.min("quality") == 0, F.max("toxic") == 1
    domain = F.when(low, "low").when(toxic, "toxic").otherwise("good")
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.coalesce("quality", "toxic").isNotNull())
        .groupBy("doc_id")
        .agg(domain.alias("domain"))
    )
    return docs.select("doc_id", "text").join(broadcast_if_small(marks), "doc_id").drop("doc_id")


@dataclass(frozen=True)
class Fit:
    """Documents with tokens, posteriors and rate, and how well the targets are met."""

    rated: DataFrame
    domains: list[str]
    targets: np.ndarray
    totals: np.ndarray
    tolerance: float

    @property
    def missed(self) -> float:
        """Largest distance from a target, relative to all tokens asked for."""
        if not len(self.targets) or not self.targets.sum():
            return 0.0
        return float(np.abs(self.totals - self.targets).max() / self.targets.sum())

    @property
    def met(self) -> bool:
        return self.missed <= self.tolerance


def _along(chances: list[Column], potentials: np.ndarray) -> Column:
    """The rate of a document at these potentials."""
    return F.greatest(reduce(add, [c * float(m) for c, m in zip(chances, potentials)]), F.lit(0.0))


RIDGE = 1e-10  # keeps potentials finite where no rates can meet a target
STEPS = tuple(4.0**-k for k in range(8))


def _potentials(known: DataFrame, target: np.ndarray, tolerance: float, rounds: int):
    """The domains' potentials, and the domain totals at these."""
    width = len(target)
    chances = [F.get("posteriors", F.lit(d)) for d in range(width)]
    offers = [F.col("tokens") * chance for chance in chances]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]

    def totals(*many: np.ndarray) -> np.ndarray:
        sums = [F.sum(_along(chances, m) * offer) for m in many for offer in offers]
        return np.array(known.agg(*sums).first(), float).reshape(len(many), width)

    def worth(m: np.ndarray, sums: np.ndarray) -> float:
        return (m @ sums + ridge * m @ m) / 2 - target @ m

    now, ridge, best = np.ones(width), 0.0, None
    for _ in range(rounds):
        rate = _along(chances, now)
        gram = [F.sum(F.when(rate > 0, offers[i] * chances[j]).otherwise(0.0)) for i, j in pairs]
        row = np.array(known.agg(*[F.sum(rate * offer) for offer in offers], *gram).first(), float)
        sums, metric = row[:width], np.zeros((width, width))
        for (i, j), value in zip(pairs, row[width:]):
            metric[i, j] = metric[j, i] = value
        ridge = ridge or RIDGE * np.trace(metric)
        best = sums
        if np.abs(sums - target).max() <= tolerance * target.sum() / 10:
            break
        step = np.linalg.solve(metric + ridge * np.eye(width), target - sums - ridge * now)
        many = [now + size * step for size in STEPS]
        tried = totals(*many)
        values = [worth(m, t) for m, t in zip(many, tried)]
        chosen = int(np.argmin(values))
        if not values[chosen] < worth(now, sums):
            break
        now, best = many[chosen], tried[chosen]
    return now, best


def fit(
    docs: DataFrame,
    model: Classifier,
    weights: dict[str, float],
    growth: float | None = 1.0,
    whole: tuple[str, ...] = (),
    strength: float = 100.0,
    tolerance: float = 1e-4,
    rounds: int = 100,
) -> Fit:
    """Rates for ``docs``, with tokens, posteriors and rate added.

    ``weights`` are the target shares of the domains, ``growth`` the target number of
    expected tokens relative to the present one. Without it, that is the smallest one for
    which no text that is surely of a domain of ``whole`` has a rate under 1, or 1 if none
    of them has tokens and a target. Rounds end when every domain is within a tenth of
    ``tolerance`` of its target, relative to the total, when no step helps, or after
    ``rounds``, far more than it takes; see ``Fit.met``.
    """
    docs = docs.drop("tokens", "posteriors", "rate")
    slots = docs.withColumn("_slots", _slots(words_of("text")))
    known = slots.withColumns(
        {
            "tokens": F.size("_slots").cast("long"),
            "posteriors": model.posteriors("_slots", strength),
        }
    ).drop("_slots")
    rated = materialise(known, "posteriors")
    width = len(model.domains)
    present = rated.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first().n
    if not width or not present:
        return Fit(rated.withColumn("rate", F.lit(1.0)), model.domains, np.zeros(0), np.zeros(0), tolerance)
    shares = np.array([max(0.0, weights.get(domain, 0.0)) for domain in model.domains])
    shares = shares / shares.sum() if shares.sum() else np.full(width, 1 / width)
    target = shares * float(present)
    potentials, totals = _potentials(rated, target, tolerance, rounds)
    if growth is None:  # as many times the targets are as many times the rates
        asked = [d for d, domain in enumerate(model.domains) if domain in whole and shares[d] and totals[d] >= 1]
        growth = max([1 / potentials[d] for d in asked if potentials[d] > 0], default=1.0)
    chances = [F.get("posteriors", F.lit(d)) for d in range(width)]
    rate = F.when(F.col("tokens") == 0, F.lit(1.0)).otherwise(_along(chances, potentials * growth))
    return Fit(rated.withColumn("rate", rate), model.domains, target * growth, totals * growth, tolerance)


def fit_rates(docs: DataFrame, model: Classifier, weights: dict[str, float], **how) -> DataFrame:
    """The rated documents of ``fit``; warns if a target is not met."""
    found = fit(docs, model, weights, **how)
    if not found.met:
        warnings.warn(f"the mix misses a target by {found.missed:.2%} of all tokens", stacklevel=2)
    return found.rated


def resample(rated: DataFrame) -> DataFrame:
    """Rows repeated as their rates say: the whole part always, the rest by a hash of the
    text, so the same table gives the same rows. Drops the three added columns."""
    draw = F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    return (
        rated.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies)))
        .drop("_copy", "tokens", "posteriors", "rate")
    )
