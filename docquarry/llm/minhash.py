"""Near duplicates by a signature-coordinate inverted join, confirmed on full sets.

A text is the set of its word shingles; its signature has one minimum hash for each of
``width`` coordinates, and every (coordinate, value) pair is a posting. Texts that are
similar enough agree in at least ``least`` coordinates (see ``least_matches``).

* Texts with equal sets are one class and posted once, by their smallest id.
* Prefix: two signatures that agree in ``least`` of ``width`` coordinates share one of
  the ``width - least + 1`` rarest postings of each. Only those are kept, and values
  nothing else has count towards them, so most texts post nothing at all and hot values
  come last.
* Skip: each posting list elects its most central text as hub, the texts of all lists
  with one hub are a cloud, and any two texts that share a kept posting meet in a cloud.
  There, coordinates that agree are counted, pairs below the threshold or already joined
  through others are skipped, and the rest is confirmed on the full sets.
* A cloud that fits a chunk is one task. A larger one is cut into chunks, and its texts are
  first confirmed with the hub alone, each once. Texts that link with the hub need not be
  compared with each other; those left over are, in tasks of two chunks, with each other
  and with the rest of the cloud. A chunk is bounded by texts and by shingles. A task
  returns a spanning tree of the links it confirmed, never all pairs.

Defined results: words are runs of anything but ASCII white space, A-Z in lower case; a
text with fewer words than a shingle is one shingle; null and blank texts have no
shingles and link with nothing; so do rows without an id, their component is null and
they are kept; rows that repeat an id belong to one node; further columns are ignored.
"""

from __future__ import annotations

from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.components import components
from docquarry.llm.repeats import Words, mix, numbers
from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise

SIGNED = "doc_id long, n_shingles long, digest binary, signature array<int>"
EDGES = "a long, b long"
TOLD = "hub long, a long, b long, size long"
CHUNK = 512  # texts of a cloud on each side of a task
CHUNK_SHINGLES = 400_000  # of the texts of a chunk, by expectation
BLOCK = 200  # texts whose shingles are hashed together


def least_matches(width: int, percent: int) -> int:
    """Coordinates two texts of that similarity agree in, but for one pair in 100,000."""
    share = percent / 100
    return max(1, floor(width * share - 4.7 * sqrt(width * share * (1 - share))))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words([(t or "").encode().lower() for t in texts])
    runs = words.runs(size, 6)
    out = []
    for first, last in zip(words.first.tolist(), words.last.tolist()):
        if last - first >= size:
            out.append(np.unique(runs[first : last - size + 1]))
        elif last > first:
            out.append(words.runs(last - first, 100 + last - first, np.array([first])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], width: int) -> np.ndarray:
    """Minimum hashes, one row per (nonempty) set."""
    factors, masks = numbers(width, 7), numbers(width, 8)
    every = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), width), np.uint32)
    for k in range(width):
        values = ((every ^ masks[k]) * factors[k] >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, starts)
    return out


def sign(docs: DataFrame, shingle: int, width: int) -> DataFrame:
    """Signatures (see SIGNED) of (doc_id, text), as a written table."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("signature", pa.list_(pa.int32()))]
    )

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                sets = shingle_sets(batch.column("text").to_pylist(), shingle)
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full, width).view(np.int32)) if full else iter(())
                digests, rows = [], []
                for s in sets:
                    sums = (len(s), int(s.sum()), int(mix(s).sum())) if len(s) else None
                    digests.append(sums and b"".join(v.to_bytes(8, "big") for v in sums))
                    rows.append(next(signed) if len(s) else None)
                columns = [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(rows, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(plain.mapInArrow(run, SIGNED), "signatures")


def clouds(classes: DataFrame, width: int, least: int) -> DataFrame:
    """(hub, doc_id, size) of the texts that may have a partner in the hub's cloud, hub left
    out; the size is the number of shingles."""
    posting = F.posexplode("signature").alias("coordinate", "value")
    tokens = classes.select("doc_id", "n_shingles", posting).select(
        "doc_id",
        "n_shingles",
        F.shiftleft(F.col("coordinate").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("token"),
    )
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(common, "token")
    by_text = shared.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"),  # width at most
        F.sum("df").alias("central"),
        F.max("n_shingles").alias("size"),
    )
    # postings that no other text has are the rarest and fill the prefix first
    room = F.lit(width - least + 1) - (F.lit(width) - F.size("held"))
    kept = by_text.filter(room > 0).select(
        "doc_id", "central", "size", F.explode(F.slice("held", 1, room)).alias("posting")
    )
    kept = materialise(kept.select("doc_id", "central", "size", "posting.token"), "postings")
    best = F.max(F.struct("central", (-F.col("doc_id")).alias("low")))
    lists = kept.groupBy("token").agg(best.alias("best"), F.count("*").alias("n")).filter("n > 1")
    hubs = lists.select("token", (-F.col("best.low")).alias("hub"))
    return kept.join(hubs, "token").filter("doc_id <> hub").groupBy("hub", "doc_id").agg(F.max("size").alias("size"))


def confirm(
    sets: list[np.ndarray], side: np.ndarray, width: int, least: int, percent: int, star: bool = False
) -> np.ndarray:
    """Root of each set of one task. ``side`` is 0 for the hub and for others their chunk
    (1 or 2); texts of different chunks are compared, and with one chunk all of them, but
    in a ``star`` the hub alone with all others."""
    n = len(sets)
    root = np.arange(n)
    signed = signatures(sets, width)
    sizes = np.array([len(s) for s in sets])
    two = (side == 2).any()
    order = np.argsort(side, kind="stable")
    asked = order[side[order] == 0] if star else order[:-1]
    for at, x in enumerate(asked):
        later = order[at + 1 :]
        if two and side[x]:
            later = later[side[later] != side[x]]
        low, high = np.minimum(sizes[later], sizes[x]), np.maximum(sizes[later], sizes[x])
        later = later[(root[later] != root[x]) & (100 * low >= percent * high)]
        if not len(later):
            continue
        later = later[(signed[later] == signed[x]).sum(axis=1) >= least]
        while len(later):
            # a slice at a time: what it joins need not be confirmed again
            part, later = later[:64], later[64:]
            every = np.concatenate([sets[y] for y in part])
            place = np.minimum(np.searchsorted(sets[x], every), sizes[x] - 1)
            starts = np.cumsum([0, *sizes[part][:-1]])
            both = np.add.reduceat((sets[x][place] == every).astype(np.int64), starts)
            for y in part[100 * both >= percent * (sizes[x] + sizes[part] - both)]:
                if root[y] != root[x]:
                    a, b = sorted((root[x], root[y]))
                    root[root == b] = a
            later = later[root[later] != root[x]]
    return root


def _chunks(sizes: DataFrame, name: str) -> DataFrame:
    """(hub, chunks of its texts) of texts (hub, size)."""
    wide = F.greatest(F.count("*") / F.lit(CHUNK), F.sum("size") / F.lit(CHUNK_SHINGLES))
    return sizes.groupBy("hub").agg(F.ceil(wide).cast("int").alias(name))


def _chunk(chunks) -> Column:
    return F.pmod(F.xxhash64("doc_id"), chunks).cast("int")


def _dealt(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """The tasks' rows with their texts. While the list of tasks is small, texts stay where
    they are until they are dealt out."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(broadcast_if_small(materialise(tasks, "tasks")), "doc_id")


def link(docs: DataFrame, found: DataFrame, shingle: int, width: int, least: int, percent: int) -> DataFrame:
    """Spanning edges (a, b) of the confirmed links within clouds (hub, doc_id, size)."""

    def joined(table: pa.Table):
        """Ids and sizes of the texts with shingles, and the root of each."""
        ids, side = table["doc_id"].to_numpy(), table["side"].to_numpy()
        size = table["size"].to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, side))
        texts = table["text"].to_pylist()
        sets = shingle_sets([texts[i] for i in order], shingle)
        full = [i for i, s in enumerate(sets) if len(s)]
        order = order[full]
        if len(order) < 2:
            return ids[order], size[order], np.arange(len(order))
        star = bool(table["star"][0].as_py())
        return ids[order], size[order], confirm([sets[i] for i in full], side[order], width, least, percent, star)

    def first(table: pa.Table) -> pa.Table:
        """Links of a whole cloud, or of a chunk with its hub; b is null for texts that are
        left to be compared with others."""
        hub, star = table["hub"][0].as_py(), table["star"][0].as_py()
        ids, size, root = joined(table)
        keep = ids != ids[root] if not star else ids != hub
        linked = (ids != ids[root])[keep]
        b = pa.array(ids[root][keep], pa.int64(), mask=~linked)
        return pa.table({"hub": pa.array(np.full(keep.sum(), hub)), "a": ids[keep], "b": b, "size": pa.array(size[keep], pa.int64())})

    def second(table: pa.Table) -> pa.Table:
        ids, _, root = joined(table)
        linked = np.flatnonzero(ids != ids[root])
        return pa.table({"a": pa.array(ids[linked], pa.int64()), "b": pa.array(ids[root][linked], pa.int64())})

    chunks = materialise(_chunks(found, "chunks"), "clouds-chunks")
    star = (F.col("chunks") > 1).alias("star")
    members = found.join(chunks, "hub").select(
        "hub", _chunk(F.col("chunks")).alias("i"), star, F.lit(1).alias("side"), "doc_id", "size"
    )
    hubs = chunks.select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"), star)
    hubs = hubs.select("hub", "i", "star", F.lit(0).alias("side"), F.col("hub").alias("doc_id"), F.lit(0).cast("long").alias("size"))
    rows = _dealt(docs, members.unionByName(hubs))
    told = materialise(rows.groupBy("hub", "i").applyInArrow(first, TOLD), "told")
    edges = told.filter(F.col("b").isNotNull()).select("a", "b")
    left = told.filter(F.col("b").isNull()).withColumnRenamed("a", "doc_id")
    if left.isEmpty():
        return edges
    # texts left over are chunks 0 to l - 1 of their cloud, the others l and on
    own = materialise(_chunks(left, "l"), "left-chunks")
    rest = told.join(own.select("hub"), "hub").filter(F.col("b").isNotNull()).select("hub", F.col("a").alias("doc_id"), "size")
    both = own.join(_chunks(rest, "m"), "hub", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    both = materialise(both, "left-chunks")
    left = left.join(both, "hub").withColumn("own", _chunk(F.col("l")))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("l") + F.col("m") - 1)))
    rest = rest.join(both, "hub").withColumn("own", F.col("l") + _chunk(F.col("m")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("l") - 1)))
    columns = ["hub", "own", "other", "doc_id", "size"]
    tasks = left.select(*columns).unionByName(rest.select(*columns)).select(
        "hub",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.lit(False).alias("star"),
        F.when(F.col("own") <= F.col("other"), 1).otherwise(2).alias("side"),
        "doc_id",
        "size",
    )
    return edges.unionByName(_dealt(docs, tasks).groupBy("hub", "i", "j").applyInArrow(second, EDGES))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, width: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    least = least_matches(width, percent)
    signed = sign(docs, shingle, width)
    linkable = signed.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    # equal sets have equal signatures, so any of the class will do
    classes = materialise(
        linkable.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    found = materialise(clouds(classes.select("doc_id", "n_shingles", "signature"), width, least), "clouds")
    confirmed = link(docs, found, shingle, width, least, percent)
    # an id with several texts ties their classes together
    ids = linkable.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    repeated = linkable.join(ids.filter("low <> high").select("doc_id"), "doc_id")
    tied = repeated.join(classes.select("digest", F.col("doc_id").alias("b")), "digest").select(
        F.col("doc_id").alias("a"), "b"
    )
    joined = components(confirmed.unionByName(tied))
    of_class = (
        classes.select("digest", F.col("doc_id").alias("id"))
        .join(joined, "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component_id"))
    )
    told = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    out = told.join(of_class, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
