"""Exact repeats of at least ``window`` words across and within texts, removed.

Fixed-block anchors: every text is cut into non-overlapping blocks of half a window, and
these are the index. Any repeat of a window's length holds a whole block of the place
that it repeats, so probing the index with every rolling run of a block's length misses
none. Windows around a hit are candidates; they are compared by 96-bit hashes, the
earliest place of each wins, and the others, joined where they overlap, are the maximal
repeats that go.

How it is dealt out: texts are shuffled once, into groups of a few megabytes; each group
works on whole arrays of word hashes. What meets across groups is sent as packed sorted
hashes, each hash once per group, so copies within a group are combined before the
shuffle and a passage that a third of all texts share is one entry per group:

1. group -> bucket: hashes of all rolling runs, with two marks (is a block of the index;
   occurs more than once); bucket -> group: one bit per entry, whether it is a hit;
2. group -> bucket: hashes of the windows around hits and the earliest text of the group
   that has them; bucket -> group: the hashes whose earliest place is in another group.

The groups are the same in all three passes over the texts, so Spark shuffles them once.

Defined results: words are runs of anything but ASCII white space, unchanged; a null or
empty text has no words and an empty rest; rows that share an id, or have none, are
ordered by group and text (no id before any id) and count as texts of their own; one text
must fit a task's memory; further columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20  # of text, for as many hashes as one bucket holds
KEY_BITS = 48

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """The first n of a fixed sequence of odd 64-bit numbers."""
    counter = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(counter + np.uint64(seed)) | np.uint64(1)


_BYTE = numbers(256, 1)


class Words:
    """The words of a list of texts as arrays."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        data = np.frombuffer(b" ".join([*self.texts, b""]), np.uint8)
        solid = ~_BLANK[data]
        edges = np.diff(np.r_[False, solid, False].astype(np.int8))
        self.begin, self.end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        lengths = self.end - self.begin
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        power = numbers(int(lengths.max()) if len(lengths) else 0, 2)
        parts = _BYTE[data[solid]] * power[place]
        sums = np.add.reduceat(parts, first) if len(first) else np.empty(0, np.uint64)
        self.hashes = mix(sums + lengths.astype(np.uint64))
        starts = np.cumsum([0, *(len(t) + 1 for t in self.texts)])
        bounds = np.searchsorted(self.begin, starts)
        self.first, self.last = bounds[:-1], bounds[1:]  # words of each text
        self.text_of = np.repeat(np.arange(len(self.texts)), self.last - self.first)
        self.offset = starts[:-1]
        self.data = data

    def runs(self, size: int, seed: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the runs of ``size`` words, at every word or at given ones."""
        h = self.hashes
        if at is None:
            n = max(0, len(h) - size + 1)
            total = np.zeros(n, np.uint64)
            for k, factor in enumerate(numbers(size, seed)):
                total += h[k : k + n] * factor
        else:
            total = np.zeros(len(at), np.uint64)
            for k, factor in enumerate(numbers(size, seed)):
                total += h[at + k] * factor
        return mix(total)

    def starts(self, size: int, least: int) -> np.ndarray:
        """Words where a run of ``size`` starts within a text of ``least`` words."""
        n = self.last - self.first
        number = np.where(n >= least, np.maximum(n - size + 1, 0), 0)
        skip = np.repeat(self.first - (np.cumsum(number) - number), number)
        return np.arange(number.sum()) + skip


class Group(Words):
    """The words of a group's rows, ordered by (id, text); ``ids`` has their ids."""

    def __init__(self, table: pa.Table):
        ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
        rows = [(i is not None, i or 0, (t or "").encode()) for i, t in zip(ids, texts)]
        rows.sort()
        self.ids = [i if known else None for known, i, _ in rows]
        super().__init__([t for _, _, t in rows])


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of numbers, byte by byte: of sorted ones, the high bytes
    hardly change and are compressed in the shuffle."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :width] = planes.T
    return whole.view("<u8").ravel()


def _bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _cuts(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket's share of sorted keys starts; one more at the end."""
    bucket = (keys >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


class Plan:
    """Sizes that all passes share."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.block = (window + 1) // 2  # 2 * block - 1 <= window

    def keys(self, words: Words):
        """Sorted distinct run hashes, where each run's is, and the runs' words."""
        at = words.starts(self.block, self.window)
        runs = words.runs(self.block, 3)[at] if len(at) else np.empty(0, np.uint64)
        keys, inverse = np.unique(runs >> np.uint64(64 - KEY_BITS), return_inverse=True)
        return keys, inverse, at


def _post_runs(plan: Plan, group: int, words: Words) -> list[dict]:
    keys, inverse, at = plan.keys(words)
    if not len(keys):
        return []
    in_text = at - words.first[words.text_of[at]]
    anchor = np.bincount(inverse, in_text % plan.block == 0, len(keys)) > 0
    again = np.bincount(inverse, minlength=len(keys)) > 1
    cuts = _cuts(keys, KEY_BITS, plan.buckets)
    return [
        {
            "bucket": b,
            "g": group,
            "keys": _pack(keys[i:j], KEY_BITS // 8),
            "anchor": np.packbits(anchor[i:j]).tobytes(),
            "again": np.packbits(again[i:j]).tobytes(),
        }
        for b, (i, j) in enumerate(zip(cuts, cuts[1:]))
        if j > i
    ]


def _find_hits(table: pa.Table) -> list[dict]:
    """Runs that are a block of the index somewhere and occur twice or more."""
    rows = table.select(["bucket", "g", "keys", "anchor", "again"]).to_pylist()
    keys = [_unpack(row["keys"], KEY_BITS // 8) for row in rows]
    anchor = np.concatenate([_bits(row["anchor"], len(k)) for row, k in zip(rows, keys)])
    again = np.concatenate([_bits(row["again"], len(k)) for row, k in zip(rows, keys)])
    every = np.concatenate(keys)
    order = np.argsort(every)
    ordered = every[order]
    run = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
    count = np.bincount(run, 1 + again[order])
    hit = np.empty(len(every), bool)
    hit[order] = ((np.bincount(run, anchor[order]) > 0) & (count > 1))[run]
    out, at = [], 0
    for row, k in zip(rows, keys):
        part = hit[at : at + len(k)]
        at += len(k)
        if part.any():
            out.append({"g": row["g"], "bucket": row["bucket"], "bits": np.packbits(part).tobytes()})
    return out


def _windows(plan: Plan, words: Words, at: np.ndarray):
    """Distinct windows at the given words in hash order: the hashes, the place of each
    window's first occurrence, and for each given word whether it is that."""
    one = words.runs(plan.window, 4, at)
    two = words.runs(plan.window, 5, at)
    order = np.lexsort((at, two, one))
    a, b = one[order], two[order]
    first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(at) else np.empty(0, bool)
    lead = order[first]
    is_first = np.zeros(len(at), bool)
    is_first[lead] = True
    return one, two, lead, is_first


def _post_windows(plan: Plan, group: int, words: Group, bitmaps: list[dict]) -> list[dict]:
    keys, inverse, at = plan.keys(words)
    hit = np.zeros(len(keys), bool)
    cuts = _cuts(keys, KEY_BITS, plan.buckets)
    for row in bitmaps:
        i, j = cuts[row["bucket"]], cuts[row["bucket"] + 1]
        hit[i:j] = _bits(row["bits"], j - i)
    marks = np.zeros(len(words.hashes) + 1, np.int64)
    marks[at] = hit[inverse]
    sums = np.r_[0, np.cumsum(marks)]
    start = words.starts(plan.window, plan.window)
    near = sums[start + plan.window - plan.block + 1] - sums[start] > 0
    start = start[near]
    if not len(start):
        return []
    one, two, lead, _ = _windows(plan, words, start)
    owner = words.text_of[start[lead]]
    known = np.array([i is not None for i in words.ids])[owner]
    ids = np.array([i or 0 for i in words.ids], np.int64)[owner]
    one, two = one[lead], two[lead]
    cuts = _cuts(one, 64, plan.buckets)
    return [
        {
            "bucket": b,
            "g": group,
            "one": _pack(one[i:j], 8),
            "two": _pack(two[i:j], 4),
            "ids": _pack(ids[i:j].view(np.uint64), 8),
            "known": np.packbits(known[i:j]).tobytes(),
        }
        for b, (i, j) in enumerate(zip(cuts, cuts[1:]))
        if j > i
    ]


def _find_losers(table: pa.Table) -> list[dict]:
    """Windows whose earliest text is in another group."""
    rows = table.select(["g", "one", "two", "ids", "known"]).to_pylist()
    one = [_unpack(row["one"], 8) for row in rows]
    sizes = [len(x) for x in one]
    every = np.concatenate(one)
    two = np.concatenate([_unpack(row["two"], 4) for row in rows])
    ids = np.concatenate([_unpack(row["ids"], 8).view(np.int64) for row in rows])
    known = np.concatenate([_bits(row["known"], n) for row, n in zip(rows, sizes)])
    group = np.repeat([row["g"] for row in rows], sizes)
    order = np.lexsort((group, ids, known, two, every))
    a, b = every[order], two[order]
    loser = np.empty(len(every), bool)
    loser[order] = np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])]
    out, at = [], 0
    for row, x in zip(rows, one):
        part = x[loser[at : at + len(x)]]
        at += len(x)
        if len(part):
            out.append({"g": row["g"], "lost": _pack(part, 8)})
    return out


def _remove(plan: Plan, words: Group, lost: list[dict]) -> list[dict]:
    start = words.starts(plan.window, plan.window)
    one, _, _, is_first = _windows(plan, words, start)
    gone = ~is_first
    if lost:
        hashes = np.sort(np.concatenate([_unpack(row["lost"], 8) for row in lost]))
        place = np.minimum(np.searchsorted(hashes, one), len(hashes) - 1)
        gone |= hashes[place] == one
    edge = np.zeros(len(words.hashes) + 1, np.int64)
    edge[start[gone]] += 1
    np.subtract.at(edge, start[gone] + plan.window, 1)
    covered = np.cumsum(edge)[:-1] > 0
    out = []
    for number, (doc_id, i, j) in enumerate(zip(words.ids, words.first, words.last)):
        cut = covered[i:j]
        pieces = words.texts[number].split()
        sides = np.flatnonzero(np.diff(np.r_[False, cut, False]))
        kept = pieces if not cut.any() else [w for w, c in zip(pieces, cut.tolist()) if not c]
        out.append(
            {
                "doc_id": doc_id,
                "n_words": len(pieces),
                "n_removed": int(cut.sum()),
                "removed": [{"start": int(s), "end": int(e)} for s, e in zip(sides[::2], sides[1::2])],
                "kept_text": b" ".join(kept).decode(),
            }
        )
    return out


RUNS = "bucket int, g long, keys binary, anchor binary, again binary"
HITS = "g long, bucket int, bits binary"
WINDOWS = "bucket int, g long, one binary, two binary, ids binary, known binary"
LOST = "g long, lost binary"
RESULT = (
    "doc_id long, n_words long, n_removed long,"
    " removed array<struct<start:bigint,end:bigint>>, kept_text string"
)


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), see RESULT: removed word ranges, end
    exclusive, and the kept words joined by one space."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, plan = max(1, ceil(size / GROUP_BYTES)), Plan(window, max(1, ceil(size / BUCKET_BYTES)))
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("long")
    dealt = docs.select(group.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def schema_of(ddl: str) -> pa.Schema:
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])

    result = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("kept_text", pa.string()),
        ]
    )
    runs, hits, windows, lost = map(schema_of, (RUNS, HITS, WINDOWS, LOST))

    def post_runs(table: pa.Table) -> pa.Table:
        words = Group(table)
        return pa.Table.from_pylist(_post_runs(plan, table["g"][0].as_py(), words), runs)

    def find_hits(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_find_hits(table), hits)

    def post_windows(table: pa.Table, bitmaps: pa.Table) -> pa.Table:
        if not bitmaps.num_rows:  # no hit, no repeat
            return windows.empty_table()
        rows = _post_windows(plan, table["g"][0].as_py(), Group(table), bitmaps.to_pylist())
        return pa.Table.from_pylist(rows, windows)

    def find_losers(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_find_losers(table), lost)

    def remove(table: pa.Table, losers: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_remove(plan, Group(table), losers.to_pylist()), result)

    by_group = dealt.groupBy("g")
    hit = by_group.applyInArrow(post_runs, RUNS).groupBy("bucket").applyInArrow(find_hits, HITS)
    around = by_group.cogroup(hit.groupBy("g")).applyInArrow(post_windows, WINDOWS)
    losers = around.groupBy("bucket").applyInArrow(find_losers, LOST)
    return by_group.cogroup(losers.groupBy("g")).applyInArrow(remove, RESULT)
