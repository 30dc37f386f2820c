"""Language identification in two levels: the family first, then the language in it.

A text becomes hashed counts of its letter 1-, 2- and 3-grams (lower case, words
marked at their ends), as square roots of relative frequencies. Linear support vector
machines separate each family from all others; within a family, one machine per pair
of languages separates the closely related ones and the pairs vote. Every machine's
margin is turned into a probability by a logistic curve fitted on a part of the sample
the machine did not learn from; the score is the family's probability times the
language's within it, which couples the pairs: 1 / (sum of 1 / p_ij - (m - 2)) for m
languages, made to add up to 1. It is 1 for a unanimous winner, 1/m without any preference.

The machines learn from a bounded sample of the labelled rows (``sample_rows``, dealt
evenly over the languages and chosen by a hash of the text); whole texts are read.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is
every text if nothing labelled was there to learn from; with one language, each text
with a letter is that language with score 1; equal scores go to the smaller name;
repeated rows are predicted each; further columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
WIDTH = 2048
CHUNK = 1 << 20

# Language codes by family. A language not listed is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indic": "hi ur bn mr gu pa ne si",
    "semitic": "ar he mt am",
    "celtic": "ga cy gd br",
}


def family_of(language: str) -> str:
    for family, members in FAMILIES.items():
        if language in members.split():
            return family
    return language


# ---------------------------------------------------------------- features

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def features(text: str | None) -> np.ndarray | None:
    """Square roots of relative hashed n-gram frequencies; None without a letter."""
    counts = np.zeros(WIDTH)
    table = _letter_table()
    for start in range(0, len(text or ""), CHUNK):
        part = text[start : start + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = table[codes]
        if not letter.any():
            continue
        marked = np.concatenate([[0], np.where(letter, codes, 0), [0]]).astype(np.uint64)
        here = np.concatenate([[False], letter, [False]])
        keep = here[1:] | here[:-1]  # of a run of other characters one mark stays
        marked, here = marked[1:][keep], here[1:][keep]
        two = marked[:-1] * np.uint64(0x110000) + marked[1:]
        grams = [marked[here] + np.uint64(1 << 62), two + np.uint64(1 << 61)]
        if len(marked) > 2:
            grams.append(two[:-1] * np.uint64(0x110000) + marked[2:])
        for gram in grams:
            mixed = (gram ^ gram >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
            slot = mixed >> np.uint64(64 - WIDTH.bit_length() + 1)
            counts += np.bincount(slot.astype(np.int64), minlength=WIDTH)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else None


# ---------------------------------------------------------------- machines


@dataclass
class Machine:
    """A linear support vector machine with a fitted probability curve."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def fit_machine(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 15) -> Machine:
    """Dual coordinate ascent on the hinge loss; classes weigh the same. The last
    fifth of the (shuffled) rows fits the probability curve."""
    rng = np.random.default_rng(0)
    order = rng.permutation(len(x))
    cut = len(x) - len(x) // 5
    learn, tune = order[:cut], order[cut:]
    y = np.where(positive, 1.0, -1.0)
    share = {s: max(1, int((y[learn] == s).sum())) for s in (1.0, -1.0)}
    limit = np.array([cost * len(learn) / 2 / share[s] for s in y])
    wide = np.hstack([x, np.ones((len(x), 1), x.dtype)])  # single precision, to stay small
    norms = np.einsum("ij,ij->i", wide, wide).astype(np.float64)
    alpha, weights = np.zeros(len(x)), np.zeros(wide.shape[1])
    for _ in range(rounds):
        for i in rng.permutation(learn):
            gradient = y[i] * (wide[i] @ weights) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), limit[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * wide[i]
                alpha[i] = new
    machine = Machine(weights[:-1].astype(np.float32), float(weights[-1]))
    margins = x[tune] @ machine.weights + machine.bias
    target = np.where(y[tune] > 0, 0.995, 0.005)
    a, b = 3.0, 0.0
    for _ in range(50):  # gradient steps on the logistic loss
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        if len(tune):
            a = max(0.1, a - 2.0 * float(np.mean((p - target) * margins)))
            b -= 2.0 * float(np.mean(p - target))
    machine.slope, machine.shift = a, b
    return machine


@dataclass
class Model:
    families: dict[str, list[str]] = field(default_factory=dict)
    family_machines: dict[str, Machine] = field(default_factory=dict)
    pair_machines: dict[tuple[str, str], Machine] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names and scores of the rows of a feature matrix."""
        names = sorted(self.families)
        if len(names) > 1:
            chances = np.stack([self.family_machines[name].probability(x) for name in names])
            chances = np.maximum(chances, 1e-12)
            chances /= chances.sum(axis=0)
        else:
            chances = np.ones((1, len(x)))
        chosen = chances.argmax(axis=0)
        out, score = np.empty(len(x), object), chances.max(axis=0).astype(np.float64)
        for place, name in enumerate(names):
            rows = np.flatnonzero(chosen == place)
            members = self.families[name]
            m = len(members)
            votes, odds = np.zeros((m, len(rows))), np.full((m, len(rows)), 2.0 - m)
            for i, j in combinations(range(m), 2):
                p = np.clip(self.pair_machines[members[i], members[j]].probability(x[rows]), 1e-12, 1 - 1e-12)
                votes[i] += p
                votes[j] += 1 - p
                odds[i] += 1 / p
                odds[j] += 1 / (1 - p)
            within = 1 / np.maximum(odds, 1.0)  # pairwise coupling
            within /= within.sum(axis=0)
            best = votes.argmax(axis=0)
            out[rows] = np.array(members, object)[best]
            score[rows] *= within[best, np.arange(len(rows))]
        return out, np.clip(score, 0.0, 1.0)


def fit(x: np.ndarray, languages: np.ndarray) -> Model:
    """Train all machines of both levels."""
    model = Model()
    for language in sorted(set(languages)):
        model.families.setdefault(family_of(language), []).append(language)
    families = np.array([family_of(language) for language in languages])
    if len(model.families) > 1:
        for name in model.families:
            model.family_machines[name] = fit_machine(x, families == name)
    for members in model.families.values():
        for pair in combinations(members, 2):
            rows = np.isin(languages, pair)
            model.pair_machines[pair] = fit_machine(x[rows], languages[rows] == pair[0])
    return model


# ---------------------------------------------------------------- Spark


def train(labelled: DataFrame, sample_rows: int = 4000) -> Model:
    """Learn from (text, lang). The sample has about ``sample_rows`` rows at most, the
    same number for each language; texts are reduced to features before they leave
    the executors."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row.lang: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model()
    each = max(1, sample_rows // len(counts))
    share = F.create_map(
        *[c for name, n in counts.items() for c in (F.lit(name), F.lit(min(1.0, each / n)))]
    )
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < F.element_at(share, F.col("lang"))).select("lang", "text")

    def run(batches):
        for batch in batches:
            found = [(g, features(t)) for g, t in zip(*map(pa.Array.to_pylist, batch.columns))]
            found = [(g, f) for g, f in found if f is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in found], pa.string()), pa.array([f.tobytes() for _, f in found], pa.binary())],
                names=["lang", "x"],
            )

    learned = sample.mapInArrow(run, "lang string, x binary").toPandas().sort_values(["lang", "x"])
    if learned.empty:
        return Model()
    languages = learned["lang"].to_numpy(object)
    x = np.frombuffer(b"".join(learned.pop("x")), np.float32).reshape(-1, WIDTH)
    return fit(x, languages)


def predict(docs: DataFrame, model: Model, block: int = 256) -> DataFrame:
    """``docs`` with lang_pred and score added (columns of these names are replaced);
    only the text is looked at."""
    docs = docs.drop("lang_pred", "score")

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for start in range(0, len(texts), block):
                found = [(start + i, features(t.as_py())) for i, t in enumerate(texts[start : start + block])]
                found = [(i, f) for i, f in found if f is not None]
                if found and model.families:
                    places = [i for i, _ in found]
                    names[places], scores[places] = model.predict(np.stack([f for _, f in found]))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added))


def held_out(id_column: str, parts: int, part: int) -> Column:
    """Whether the id's CRC-32, as text, falls into the part kept for testing. Rows
    without an id count as kept for testing."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % parts == part, F.lit(True))
