"""Near duplicates among vectors by a subspace pigeonhole join.

Unit vectors with a cosine of at least ``least`` lie within a squared distance of
2 - 2 * least. They are rotated at random and cut into low-dimensional blocks; a pair that
close must, in one block at least, lie within the block's proportional part of that
budget. Every block is range-joined on its own: a grid over its first coordinate, as wide
as the block's radius, brings together all that can qualify. The candidates of all blocks
are verified by the exact cosine of the original vectors, each pair only in the first
block it qualifies in, so nothing is counted twice and no list of candidates is shuffled.

Cells are cut into chunks of at most about ``chunk`` vectors and each pair of chunks is a
task, so a hot cell is spread out. Equal vectors are one row with their number. A task
returns each vector's number of links and a spanning tree of them, never the pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components link
with nothing and are kept as components of their own; vectors of unlike dimension never
link; a row without an id has no component, is not linked and is kept; rows that repeat an
id are vectors of their own with that id and a link between them counts; further columns
are ignored.
"""

from __future__ import annotations

from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.ann_bits import rotation, rows_of, usable
from docquarry.llm.components import components
from docquarry.sources.shared import materialise

SLACK = 1e-5  # rounding of the rotated vectors, kept in single precision
SINGLE = 2e-5  # rounding of squared distances in single precision; vectors have length 1
LINKS = "id long, n_links long, to long"


def edges_of(width: int, blocks: int) -> list[tuple[int, int]]:
    cuts = [width * b // blocks for b in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def _turn(vectors: DataFrame, seed: int) -> DataFrame:
    """Adds the rotated unit vector."""

    def run(batches):
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = rows_of(part.column("vector")).astype(np.float64)
                if dim not in turns:
                    turns[dim] = rotation(int(dim), seed)
                unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                turned = (unit @ turns[dim]).astype(np.float32)
                width = turned.shape[1]
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
                lists = pa.ListArray.from_arrays(ends, pa.array(turned.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "n", "dim", "vector")), lists],
                    names=["id", "n", "dim", "vector", "turned"],
                )

    placed = vectors.select("id", "n", "dim", "vector").schema.fields
    turned = T.StructField("turned", T.ArrayType(T.FloatType()))
    return vectors.mapInArrow(run, T.StructType([*placed, turned]))


class Table:
    """Vectors of one side of a task."""

    def __init__(self, table: pa.Table):
        self.ids, self.n = table["id"].to_numpy(), table["n"].to_numpy()
        self.vectors = rows_of(table["vector"]).astype(np.float64)
        self.turned = rows_of(table["turned"]).astype(np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))


def _verify(a: Table, b: Table, i, j, block: int, bounds, budgets, least: float):
    """Of candidate places, those whose first qualifying block is this one and whose
    cosine suffices."""
    gap = (a.turned[i] - b.turned[j]) ** 2
    first = np.full(len(i), -1)
    for number in range(block, -1, -1):
        low, high = bounds[number]
        first[gap[:, low:high].sum(axis=1) <= budgets[number]] = number
    own = first == block
    i, j = i[own], j[own]
    cosine = np.einsum("ij,ij->i", a.vectors[i], b.vectors[j]) / (a.norms[i] * b.norms[j])
    close = cosine >= least
    return i[close], j[close]


def join_chunks(a: Table, b: Table, same: bool, block: int, bounds, budgets, least: float):
    """Links of one task: number of linked vectors of each row, and tree edges of places
    (rows of b counted on from those of a)."""
    low, high = bounds[block]
    pa_, pb_ = a.turned[:, low:high], b.turned[:, low:high]
    sa, sb = np.einsum("ij,ij->i", pa_, pa_), np.einsum("ij,ij->i", pb_, pb_)
    # squared distances as one product in single precision; what passes is verified in double
    one_a, one_b = np.ones((len(sa), 1)), np.ones((len(sb), 1))
    left = np.hstack([-2 * pa_, sa[:, None], one_a]).astype(np.float32)
    right = np.hstack([pb_, one_b, sb[:, None]]).astype(np.float32).T.copy()
    most = np.float32(budgets[block] + SLACK + SINGLE)
    na, nb = np.zeros(len(sa), np.int64), np.zeros(len(sb), np.int64)
    root = np.arange(len(sa) + (0 if same else len(sb)))
    shift = 0 if same else len(sa)
    edges = []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    step = max(1, (1 << 20) // max(1, len(sb)))
    for start in range(0, len(sa), step):
        stop = min(start + step, len(sa))
        near = np.flatnonzero(left[start:stop] @ right <= most)
        i, j = np.divmod(near, len(sb))
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 16):
            x, y = _verify(a, b, i[at : at + (1 << 16)], j[at : at + (1 << 16)], block, bounds, budgets, least)
            np.add.at(na, x, b.n[y])
            np.add.at(nb, y, a.n[x])
            for u, v in zip(x.tolist(), (y + shift).tolist()):
                ru, rv = find(u), find(v)
                if ru != rv:
                    root[max(ru, rv)] = min(ru, rv)
                    edges.append((u, v))
    return (na + nb if same else np.r_[na, nb]), edges


def _task(bounds, budgets, least: float):
    """The function of one group: a pair of chunks, or one chunk with itself."""

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        a, block = Table(table.filter(pa.array(side == 1))), table["block"][0].as_py()
        head = table.slice(0, 1).to_pylist()[0]
        same = head["low"] == head["high"] and head["u"] == head["v"]
        b = a if same else Table(table.filter(pa.array(side == 2)))
        empty = pa.table({name: pa.array([], pa.int64()) for name in ("id", "n_links", "to")})
        if not len(a.ids) or not len(b.ids):
            return empty
        counts, edges = join_chunks(a, b, same, block, bounds, budgets, least)
        ids = a.ids if same else np.r_[a.ids, b.ids]
        linked = np.flatnonzero(counts)
        if not len(linked):
            return empty
        x = np.array([e[0] for e in edges], np.int64)
        y = np.array([e[1] for e in edges], np.int64)
        return pa.table(
            {
                "id": np.r_[ids[linked], ids[x]],
                "n_links": np.r_[counts[linked], np.zeros(len(x), np.int64)],
                "to": pa.array([None] * len(linked) + ids[y].tolist(), pa.int64()),
            }
        )

    return run


def links(
    vectors: DataFrame, least: float = 0.9, blocks: int = 4, chunk: int = 16_384, seed: int = 0
) -> DataFrame:
    """(id, n_links, to) for distinct vectors (id, n, vector): parts of each one's number
    of linked vectors, and where ``to`` is not null an edge of the spanning trees."""
    spark = vectors.sparkSession
    sized = vectors.select("id", "n", F.size("vector").alias("dim"), "vector")
    placed = materialise(_turn(sized, seed), "turned")
    budget = 2 - 2 * least
    parts = []
    for dim in sorted(row.dim for row in placed.select("dim").distinct().collect()):
        bounds = edges_of(64 * ceil(dim / 64), blocks)
        width = bounds[-1][1]
        budgets = [budget * (high - low) / width + SLACK for low, high in bounds]
        own = placed.filter(F.col("dim") == dim)
        cells = [
            F.struct(
                F.lit(number).alias("block"),
                F.floor(F.get("turned", F.lit(low)) / sqrt(budgets[number])).cast("int").alias("cell"),
            )
            for number, (low, _) in enumerate(bounds)
        ]
        celled = own.withColumn("c", F.explode(F.array(*cells))).select("id", "n", "vector", "turned", "c.*")
        # a cell for each step of the radius from -1 to 1: a bounded, small number
        counts = {(r.block, r.cell): r["count"] for r in celled.groupBy("block", "cell").count().collect()}
        chunks = {key: ceil(n / chunk) for key, n in counts.items()}
        tasks = []
        for (number, cell), n in chunks.items():
            for other in (cell, cell + 1):
                m = chunks.get((number, other), 0)
                tasks.append((number, cell, other, n, m))
        plan = spark.createDataFrame(
            [(*task, side) for task in tasks if task[4] for side in (1, 2)],
            "block int, low int, high int, n_low int, n_high int, side int",
        )
        plan = plan.withColumn("cell", F.when(F.col("side") == 1, F.col("low")).otherwise(F.col("high")))
        dealt = celled.join(F.broadcast(plan), ["block", "cell"])
        mine = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 1, F.col("n_low")).otherwise(F.col("n_high"))).cast("int")
        others = F.when(F.col("side") == 1, F.col("n_high")).otherwise(F.col("n_low"))
        dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
        first = F.when(F.col("side") == 1, F.col("mine")).otherwise(F.col("other")).alias("u")
        second = F.when(F.col("side") == 1, F.col("other")).otherwise(F.col("mine")).alias("v")
        dealt = dealt.select("block", "low", "high", first, second, "side", "id", "n", "vector", "turned")
        # within a cell, a chunk meets itself once and every later chunk once
        dealt = dealt.filter(
            "low < high OR (u < v) OR (u = v AND side = 1)"
        )

        parts.append(dealt.groupBy("block", "low", "high", "u", "v").applyInArrow(_task(bounds, budgets, least), LINKS))
    if not parts:
        return spark.createDataFrame([], LINKS)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return materialise(whole, "vector-links")


def near_duplicates(
    vectors: DataFrame, id_column: str, vector_column: str, least: float = 0.9, blocks: int = 4, seed: int = 0
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``."""
    raw = F.col(vector_column)
    clean = F.when(F.col(id_column).isNotNull() & usable(vector_column), raw)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), clean.alias("vector"))
    distinct = (
        rows.filter(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("n"))
    )
    # a number of its own for each distinct vector, as an id may have several; written, so it stays
    keyed = materialise(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct-vectors")
    found = links(keyed.select(F.col("key").alias("id"), "n", "vector"), least, blocks, seed=seed)
    counted = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return _resolve(rows, keyed, found, counted)


def _resolve(rows: DataFrame, keyed: DataFrame, found: DataFrame, counted: DataFrame) -> DataFrame:
    """Component and links of every row from those of the distinct vectors."""
    edges = found.filter(F.col("to").isNotNull()).select(F.col("id").alias("x"), F.col("to").alias("y"))
    names = keyed.select("key", F.col("id").alias("name"))
    a = edges.join(names.select(F.col("key").alias("x"), F.col("name").alias("a")), "x")
    named = a.join(names.select(F.col("key").alias("y"), F.col("name").alias("b")), "y").select("a", "b")
    joined = components(named)
    of_vector = (
        keyed.join(counted.withColumnRenamed("id", "key"), "key", "left")
        .join(joined, "id", "left")
        .select(
            "vector",
            (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    out = rows.join(of_vector, "vector", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
