"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Each vector is rotated at random and kept as the signs of its coordinates, packed,
with two scalars: its length and the cosine between the rotated vector and its sign
vector. The inner product with a query is estimated from the packed bits alone: the
rotated query is rounded to 8-bit levels and its bit planes are counted against the
code. An error bound tells which vectors may still be among the best k; only those
are scored exactly, in double precision, on the original vectors.

Spark deals vectors and queries into blocks; every pair of a vector block and a query
block is one group, so no task holds more than two blocks however large the table.
A group returns k rows per query, and the best k of those win.

Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without an id; of rows that repeat an id the smallest usable
vector counts; vectors of unlike dimension are never compared; ties go to the smaller
id; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.sources.shared import materialise

PLANES = 8
CODES = "id long, dim int, vector array<double>, code binary, norm double, agreement double"
FOUND = "query_id long, id long, score double"


def usable(vector: str) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def clean_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector): usable vectors in double precision, one per id."""
    typed = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    return (
        typed.filter(F.col("id").isNotNull() & usable("vector"))
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
    )


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    """A random rotation of ``dim`` coordinates, padded to whole 64-bit words."""
    width = 64 * ceil(dim / 64)
    normal = np.random.default_rng(seed).standard_normal((width, width))
    q, r = np.linalg.qr(normal)
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:dim])


def rows_of(column) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = chunk.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(chunk), -1)


def encode(vectors: DataFrame, seed: int = 0) -> DataFrame:
    """Codes (see CODES) of a table (id, vector), as a written table."""

    def run(batches):
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = rows_of(part.column("vector"))
                if dim not in turns:
                    turns[dim] = rotation(int(dim), seed)
                norms = np.sqrt(np.einsum("ij,ij->i", x, x))
                turned = (x / norms[:, None]) @ turns[dim]
                bits = np.packbits(turned > 0, axis=1, bitorder="little")
                agreement = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("dim"),
                        part.column("vector"),
                        pa.array([row.tobytes() for row in bits], pa.binary()),
                        pa.array(norms),
                        pa.array(agreement),
                    ],
                    names=["id", "dim", "vector", "code", "norm", "agreement"],
                )

    sized = vectors.select("id", F.size("vector").alias("dim"), "vector")
    return materialise(sized.mapInArrow(run, CODES), "bit-codes")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search_block(queries, vectors, codes, norms, agreement, ids, query_ids, turn, k, spread):
    """(query place, vector place, score) of the best k in one block for each query."""
    width = turn.shape[1]
    words = codes.view(np.uint64)
    root = np.sqrt(width)
    ones = np.bitwise_count(words).sum(axis=1).astype(np.float64)
    slack = spread * np.sqrt(np.maximum(1 - agreement**2, 0)) / agreement / np.sqrt(max(width - 1, 1))
    for place, query in enumerate(queries):
        length = np.sqrt(query @ query)
        turned = (query / length) @ turn
        low = turned.min()
        step = max((turned.max() - low) / (2**PLANES - 1), 1e-300)
        levels = np.rint((turned - low) / step).astype(np.uint64)
        dot = np.zeros(len(words))
        for plane in range(PLANES):
            bits = (levels >> np.uint64(plane) & np.uint64(1)).astype(np.uint8)
            mask = np.packbits(bits, bitorder="little").view(np.uint64)
            dot += np.bitwise_count(words & mask).sum(axis=1) * float(2**plane)
        # sign vector times rounded query, signs as +-1
        product = low * (2 * ones - width) + step * (2 * dot - float(levels.sum()))
        estimate = product / root / agreement
        error = slack + step / 2 * root / agreement  # of the code, and of the rounding
        scale = norms * length
        upper = (estimate + error) * scale
        others = ids != query_ids[place]
        upper[~others] = -np.inf
        rough = np.where(others, estimate * scale, -np.inf)
        first = np.argpartition(-rough, min(k, len(rough)) - 1)[:k]
        first = first[others[first]]
        if len(first) == 0:
            continue
        known = vectors[first] @ query
        least = known.min() if len(first) == k else -np.inf
        chosen = np.flatnonzero((upper >= least) & others)
        if len(first) == k:
            chosen = np.union1d(chosen, first)
        scores = np.einsum("ij,j->i", vectors[chosen], query)
        best = _best(scores, ids[chosen], k)
        yield place, chosen[best], scores[best]


def search(
    codes: DataFrame,
    queries: DataFrame,
    k: int = 20,
    seed: int = 0,
    spread: float = 3.0,
    block: int = 32_768,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every query (id, vector).

    ``spread`` is the number of standard deviations of the bits' error that a vector
    may be underestimated by and still be reranked. ``block`` bounds both the vectors
    and the queries of one group.
    """
    spark = codes.sparkSession
    asked = materialise(
        queries.select(F.col("id").alias("query_id"), F.size("vector").alias("dim"), "vector"),
        "ann-queries",
    )
    n, m = codes.count(), asked.count()
    vector_blocks, query_blocks = max(1, ceil(n / block)), max(1, ceil(m / block))

    def dealt(df: DataFrame, id_column: str, own: str, blocks: int, other: str, others: int):
        """Each row in its own block, once for every block of the other side."""
        return df.withColumn(own, F.pmod(F.xxhash64(id_column), F.lit(blocks)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        )

    left = dealt(codes, "id", "vb", vector_blocks, "qb", query_blocks)
    right = dealt(asked, "query_id", "qb", query_blocks, "vb", vector_blocks)

    def run(vectors: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if vectors.num_rows and wanted.num_rows:
            x, q = rows_of(vectors["vector"]), rows_of(wanted["vector"])
            code = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8)
            ids, query_ids = vectors["id"].to_numpy(), wanted["query_id"].to_numpy()
            found = search_block(
                q,
                x,
                code.reshape(len(x), -1),
                vectors["norm"].to_numpy(),
                vectors["agreement"].to_numpy(),
                ids,
                query_ids,
                rotation(x.shape[1], seed),
                k,
                spread,
            )
            for place, places, scores in found:
                out[0].append(np.full(len(places), query_ids[place]))
                out[1].append(ids[places])
                out[2].append(scores)
        kinds = (np.int64, np.int64, np.float64)
        columns = [np.concatenate(c) if c else np.empty(0, t) for c, t in zip(out, kinds)]
        return pa.table(dict(zip(("query_id", "id", "score"), columns)))

    keys = ("dim", "vb", "qb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)
    # every task cuts its rows to the best k of each query before the shuffle
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
