"""Spelling variants: words one edit apart, grouped under their most frequent form.

Sorted-list dynamic programming. The vocabulary is sorted and cut into blocks of a few
thousand words; a word is compared with a block by walking down the sorted list with the
rows of its edit matrix, three cells wide (one edit leaves no other). A row belongs to a
prefix, so what a word shares with its predecessor (their longest common prefix) is never
computed again, and when a row exceeds one edit, all words with that prefix are skipped.

How it is dealt out: two words one edit apart agree before their first difference, and
after it, read from the end, in all the rest. So the list is sorted twice, by words and by
reversed words, and every word has a split: partners that agree with it up to the split
are found in the first list, within the range of that prefix, the others in the second,
within the range of the remaining suffix. The split is chosen per word to touch the fewest
blocks; a prefix that very many words share moves it behind that prefix. Only block bounds
(a bounded sample of the words) reach the driver; each task returns one row per word with
the number of its near words and the best of them, never the pairs.

Defined results: null words are ignored; rows that repeat a word are added up; words below
the least length or count take no part, as words and as near words; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise

BLOCK = 4096  # words of a block, by expectation
MOST_BLOCKS = 65_536  # larger vocabularies get larger blocks
TASK_BLOCKS = 8  # blocks of a task, by expectation
SAMPLED = 8  # sampled words per block bound

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DEALT = "backward boolean, block int, word string, split int, n long"
NEAR = "word string, n_near long, best_n long, best string"


def text_words(docs: DataFrame, least_length: int = 5, noise: int | None = None) -> DataFrame:
    """(word, n): maximal runs of letters of all texts (doc_id, text) with at least
    ``least_length`` code points, A-Z in lower case; n is 1.

    With ``noise``, an occurrence whose crc32 of ``<doc_id>:<word>`` it divides loses one
    letter, at that number modulo its length. A null id counts as empty there.
    """
    pattern = f"[{LETTERS}]{{{least_length},}}+"
    run = F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    rows = docs.select("doc_id", run.alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    rows = rows.select("doc_id", lower.alias("word"))
    if noise:
        key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
        rows = rows.withColumn("h", F.crc32(key.cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        word = F.when(F.col("h") % noise == 0, shorter).otherwise(F.col("word"))
        rows = rows.select(word.alias("word")).filter(F.length("word") >= least_length)
    return rows.select("word", F.lit(1).cast("long").alias("n"))


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class SortedList:
    """Sorted distinct words, the common prefix of each with its predecessor, and for each
    the next word that shares less with its predecessor."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shared = [0] + [common_prefix(a, b) for a, b in zip(words, words[1:])]
        self.less = [len(words)] * len(words)
        waiting: list[int] = []
        for i, shared in enumerate(self.shared):
            while waiting and self.shared[waiting[-1]] > shared:
                self.less[waiting.pop()] = i
            waiting.append(i)

    def one_edit(self, asked: str, split: int) -> list[int]:
        """Places of the words exactly one edit from ``asked`` that begin with its first
        ``split`` letters."""
        words, shared, less = self.words, self.shared, self.less
        at, end, size = bisect_left(words, asked[:split]), len(words), len(asked)
        if at == end or not words[at].startswith(asked[:split]):
            return []
        padded = asked + "\0\0\0"
        # rows[d] is the row of a prefix of d letters: its distances from the first d - 1,
        # d and d + 1 letters asked for
        rows = [(1, 0, 1)] * (size + 3)
        found, depth = [], split
        while True:
            word = words[at]
            before, even, after = rows[depth]
            alive, length = True, len(word)
            while depth < length:
                if depth > size:  # longer than one more letter
                    alive = False
                    break
                letter = word[depth]
                x = before + (depth == 0 or letter != padded[depth - 1])
                if even < x:
                    x = even + 1 if even + 1 < x else x
                y = even + (letter != padded[depth])
                if after + 1 < y:
                    y = after + 1
                if x + 1 < y:
                    y = x + 1
                z = after + (letter != padded[depth + 1])
                if y + 1 < z:
                    z = y + 1
                depth += 1
                before, even, after = x, y, z
                if x > 1 and y > 1 and z > 1:
                    alive = False
                    break
                rows[depth] = (x, y, z)
            if alive:
                by = length - size
                if (even if by == 0 else before if by == 1 else after if by == -1 else 2) == 1:
                    found.append(at)
                at += 1
            else:  # no word that shares these letters can come back to one edit
                over = depth + 1 if depth > size else depth
                depth = over - 1
                at += 1
                while at < end and shared[at] >= over:
                    at = less[at]
            if at == end or shared[at] < split:
                return found
            depth = min(depth, shared[at])


def _after(prefix: str) -> str | None:
    """The smallest string behind all that begin with ``prefix``; None if there is none."""
    last = ord(prefix[-1]) if prefix else 0x10FFFF
    return prefix[:-1] + chr(last + 1) if last < 0x10FFFF else None


class Blocks:
    """Ranges of a sorted list, by their bounds."""

    def __init__(self, bounds: list[str]):
        self.bounds = bounds

    def of(self, word: str) -> int:
        return bisect_right(self.bounds, word)

    def of_prefix(self, prefix: str) -> range:
        behind = _after(prefix)
        last = len(self.bounds) if behind is None else bisect_left(self.bounds, behind)
        return range(self.of(prefix), last + 1)


def best_split(word: str, forward: Blocks, backward: Blocks) -> int:
    """Where to split the word to touch the fewest blocks; in the middle if that is free."""

    def touched(split: int) -> int:
        rest = word[split:][::-1]
        return len(forward.of_prefix(word[:split])) + len(backward.of_prefix(rest))

    middle = (len(word) + 1) // 2
    if touched(middle) == 2:
        return middle
    return min(range(len(word) + 1), key=lambda split: (touched(split), abs(split - middle)))


def _bounds(vocabulary: DataFrame, blocks: int, size: int) -> tuple[Blocks, Blocks]:
    """Bounds of both lists from a sample of about SAMPLED words a block."""
    if blocks == 1:
        return Blocks([]), Blocks([])
    drawn = F.pmod(F.xxhash64("word"), F.lit(max(1, size // SAMPLED))) == 0
    sample = [row.word for row in vocabulary.filter(drawn).select("word").collect()]
    forward, backward = sorted(sample), sorted(word[::-1] for word in sample)
    return Blocks(forward[SAMPLED::SAMPLED]), Blocks(backward[SAMPLED::SAMPLED])


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of every word that has a near one in ``vocabulary``
    (word, n), a written table with each word once."""
    total = vocabulary.count()
    size = max(block, -(-total // MOST_BLOCKS))
    forward, backward = _bounds(vocabulary, -(-total // size) or 1, size)
    dealt_schema = pa.schema(
        [("backward", pa.bool_()), ("block", pa.int32()), ("word", pa.string()), ("split", pa.int32()), ("n", pa.int64())]
    )

    def deal(batches):
        """Each word to its own two blocks, and without ``n`` to all others of its ranges."""
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                split = best_split(word, forward, backward)
                for turned, blocks in ((False, forward), (True, backward)):
                    shown = word[::-1] if turned else word
                    kept = len(word) - split if turned else split
                    own = blocks.of(shown)
                    rows += [
                        (turned, b, shown, kept, n if b == own else None) for b in blocks.of_prefix(shown[:kept])
                    ]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), dealt_schema.types)]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, schema=dealt_schema)

    def scan(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("word", "split", "n"))))
        turned = table["backward"][0].as_py()
        held = [(word, n) for word, _, n in rows if n is not None]
        listed, weight = SortedList([word for word, _ in held]), [n for _, n in held]
        out = []
        for word, split, _ in rows:
            places = listed.one_edit(word, split)
            if turned:  # those that agree from the start up to the split are found in the other list
                whole, kept = word[::-1], len(word) - split
                places = [p for p in places if not listed.words[p][::-1].startswith(whole[:kept])]
                if places:
                    low, best = min((-weight[p], listed.words[p][::-1]) for p in places)
                    out.append((whole, len(places), -low, best))
            elif places:
                low, best = min((-weight[p], listed.words[p]) for p in places)
                out.append((word, len(places), -low, best))
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns)})

    dealt = vocabulary.select("word", "n").mapInArrow(deal, DEALT)
    # a task for every few blocks: they are small, but take long
    tasks = -(-2 * (len(forward.bounds) + 1) // TASK_BLOCKS)
    dealt = dealt.repartition(tasks, "backward", "block")
    found = dealt.groupBy("backward", "block").applyInArrow(scan, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("low"), "best")).alias("b")
    both = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return both.select("word", "n_near", (-F.col("b.low")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the end of its chain of forms.

    Chains never close, as counts grow along them. Every round doubles the steps taken, so
    rounds are as many as the logarithm of the longest chain.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(broadcast_if_small(ahead), "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(
    words: DataFrame, least_length: int = 5, least_count: int = 3, factor: int = 2, block: int = BLOCK
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    The form of a word is its near word of largest n (ties: the smallest), if that has at
    least ``factor`` times its own n; the root is what following forms ends in.
    """
    if factor < 2:
        raise ValueError("a form needs at least twice the count")
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialise(counted.filter(F.col("n") >= least_count), "vocabulary")
    told = vocabulary.join(near_words(vocabulary, block), "word", "left")
    chosen = F.col("best_n") >= factor * F.col("n")
    told = materialise(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(chosen, F.col("best")).alias("form"),
            F.when(chosen, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(told.filter(F.col("form").isNotNull()))
    joined = told.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
