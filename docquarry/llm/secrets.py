"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text). The ledger
has one row for each (blob, rule with version) that was ever scanned. A run scans
only pairs the ledger lacks, each distinct blob once, and joins the findings back
to all paths and versions that hold the blob.

Defined results: a null content is an empty blob; an empty blob has no findings; a
path that is null or repeated keeps each of its rows; columns beyond the three
named ones are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.operators.joins import fits
from docquarry.sources.shared import materialise


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least
    ``least`` characters. A new pattern needs a new ``version``."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# Fixed values. The lower bounds of `access` and `hex` are part of the pattern: a run
# that is too short holds no long enough match at any later start.
RULES = (
    Rule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)

SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
PIECES = "array<struct<gap:int,len:int,kept:boolean>>"

# Matches that are added up in one go: an array that grows by one is copied each time.
BLOCK = 256


def _pieces(text: Column, rule: Rule) -> Column:
    """For each match: length of the text before it since the last one, its own
    length, and whether it is long enough. Three passes, only over texts that match;
    the arrays are zipped, as a lambda that looks into them makes them anew each time."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)  # one more than matches
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    matches = F.zip_with(
        found,
        tested,
        lambda match, part: F.struct(
            F.length(match).alias("len"), (F.length(part) >= rule.least).alias("kept")
        ),
    )
    lengths = F.filter(
        F.zip_with(
            gaps,
            matches,
            lambda gap, match: F.struct(
                F.length(gap).alias("gap"), match["len"].alias("len"), match["kept"].alias("kept")
            ),
        ),
        lambda piece: piece["len"].isNotNull(),
    )
    return F.when(text.rlike(rule.pattern), lengths).otherwise(F.array()).cast(PIECES)


def _spans(pieces: Column, kind: Column) -> Column:
    """The spans of the pieces that are long enough, in their order. Places are added up
    within blocks first, then over blocks, so that many matches of one text take neither
    a sort nor time that grows with their square."""
    last = F.floor((F.size(pieces) - 1) / F.lit(BLOCK)).cast("int")
    blocks = F.when(F.size(pieces) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def start(kind_of: str) -> Column:
        return F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind_of).alias("spans"))

    def add(done, piece):
        begin = done["at"] + piece["gap"]
        end = begin + piece["len"]
        span = F.array(F.struct(begin.alias("start"), kind.alias("kind"), end.alias("end"))).cast(SPANS)
        spans = F.when(piece["kept"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def place(done, block):
        moved = F.transform(
            block["spans"],
            lambda s: F.struct(
                (s["start"] + done["at"]).alias("start"), s["kind"].alias("kind"), (s["end"] + done["at"]).alias("end")
            ),
        )
        spans = F.concat(done["spans"], F.array(moved.cast(SPANS)))
        return F.struct((done["at"] + block["at"]).alias("at"), spans.alias("spans"))

    summed = F.transform(blocks, lambda b: F.aggregate(F.slice(pieces, b * BLOCK + 1, BLOCK), start(SPANS), add))
    return F.aggregate(summed, start(f"array<{SPANS}>"), place, lambda done: F.flatten(done["spans"]))


def address(versions: DataFrame) -> DataFrame:
    """(path, version, blob, content): contents by their SHA-256."""
    content = F.coalesce(F.col("content"), F.lit(""))
    return versions.select(
        "path", "version", F.sha2(content, 256).alias("blob"), content.alias("content")
    )


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Scan the unseen pairs; returns their ledger rows (blob, rule, spans).

    ``versions`` has path, version and content; ``ledger`` what earlier runs
    returned. Spans are (start, kind, end) in code points, end exclusive; kind is the
    rule's place in ``rules``. The result is a written table.
    """
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    # copies of a blob are combined before the shuffle, so a hot blob is one row a task
    blobs = address(versions).groupBy("blob").agg(F.first("content").alias("content"))
    if ledger is None:
        blobs = blobs.withColumn("unseen", keys)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.join(seen, "blob", "left").withColumn("unseen", unseen)
        blobs = blobs.filter(F.size("unseen") > 0)
    scanned = F.array(
        *[
            F.when(
                F.array_contains("unseen", rule.key),
                F.struct(
                    F.lit(rule.key).alias("rule"),
                    F.lit(kind).alias("kind"),
                    _pieces(F.col("content"), rule).alias("pieces"),
                ),
            )
            for kind, rule in enumerate(rules)
        ]
    )
    rows = blobs.select("blob", F.explode(F.filter(scanned, lambda s: s.isNotNull())).alias("s"))
    entries = rows.select("blob", "s.rule", _spans(F.col("s.pieces"), F.col("s.kind")).alias("spans"))
    return materialise(entries, "secret-ledger")


def spans_by_blob(ledger: DataFrame, rules=RULES) -> DataFrame:
    """(blob, spans) of the blobs with findings of the current rules; spans sorted by
    start, then by the rules' order."""
    current = ledger.filter(F.col("rule").isin([rule.key for rule in rules]))
    return (
        current.filter(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    )


def findings(versions: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """(path, version, blob, spans) of every version, from the ledger's rows. Versions
    stay where they are read, unless the blobs with findings are many."""
    found = spans_by_blob(ledger, rules)
    if fits(found.select("blob", F.inline("spans"))):
        found = F.broadcast(found)
    held = address(versions).drop("content").join(found, "blob", "left")
    return held.select(
        "path", "version", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )


def redacted(docs: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind, and ``n_chars``
    brought up to date where there is such a column."""
    columns = docs.columns
    found = spans_by_blob(ledger, rules).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    blob = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    joined = docs.withColumn("_blob", blob).join(found, "_blob", "left")
    clean = joined.withColumn(
        "text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("_spans"), rules))
    )
    if "n_chars" in columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(size))
    return clean.select(*columns)


def redact(text: Column, spans: Column, rules=RULES) -> Column:
    """The text with each found span replaced by ``[kind]``; of overlapping spans the
    first one is replaced and the others vanish with it."""
    names = F.array(*[F.lit(rule.name) for rule in rules])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done, span):
        kept = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        mark = F.concat(F.lit("["), F.get(names, span["kind"]), F.lit("]"))
        later = F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(
                span["start"] >= done["at"], F.concat(done["out"], kept, mark)
            ).otherwise(done["out"]).alias("out"),
        )
        return later

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)
