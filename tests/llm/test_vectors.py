"""One-bit codes and the subspace join against brute force."""

import numpy as np
import pytest

from conftest import SMALL, tuples
from docquarry.llm import ann_bits, vector_dups

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, id long, rank int, score double, vector int"


def frame(spark, rows):
    """Rows (vec_id, embedding) with further columns of clashing names."""
    return spark.createDataFrame([(i, v, 0, 9, 9, 9.0, 9) for i, v in rows], SCHEMA)


def nearest(spark, rows, every=20, **how):
    vectors = ann_bits.clean_vectors(frame(spark, rows), "vec_id", "embedding")
    codes = ann_bits.encode(vectors)
    return ann_bits.search(codes, codes.filter(f"id % {every} = 0").select("id", "vector"), **how)


def best(rows, every, k):
    """Brute force: (query, rank, id, score)."""
    usable = {i: np.array(v) for i, v in sorted(rows)}
    out = []
    for q, x in usable.items():
        if q % every == 0:
            scored = sorted((-float(x @ y), i) for i, y in usable.items() if i != q and len(y) == len(x))
            out += [(q, r, i, round(-s, 6)) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("block", [32_768, 60])
def test_recall_and_scores(spark, block):
    data = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in data]
    want = best(rows, 20, 20)
    got = tuples(nearest(spark, rows, block=block))
    assert len(got) == len(want)
    pairs = {(q, i): s for q, _, i, s in want}
    hit = [(q, i) for q, _, i, _ in got if (q, i) in pairs]
    assert len(hit) >= 0.99 * len(want)
    assert all(abs(s - pairs[q, i]) < 1e-6 for q, _, i, s in got if (q, i) in pairs)


def test_odd_vectors_take_no_part(spark):
    good = [(0, [1.0, 0.0, 0.0]), (1, [0.5, 0.5, 0.0]), (2, [0.5, 0.5, 0.0]), (3, [-1.0, 0.0, 0.0])]
    odd = [
        (20, None), (40, []), (4, [0.0, 0.0, 0.0]), (5, [NAN, 1.0, 1.0]), (6, [INF, 0.0, 0.0]),
        (7, [None, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (60, [1.0, 0.0]),
    ]
    got = tuples(nearest(spark, good + odd + good[1:2]), "query_id", "rank", "id", "score")
    # ties go to the smaller id, fewer than k candidates are all returned
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 3, -1.0)]


def test_many_copies_and_k(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)] + [(100, [5.0, 5.0, 5.0, 5.0])]
    got = tuples(nearest(spark, rows, every=50, k=3))
    assert got == sorted(best(rows, 50, 3), key=repr)


def test_no_vectors(spark):
    assert nearest(spark, []).isEmpty()
    assert vector_dups.near_duplicates(frame(spark, []), "vec_id", "embedding").isEmpty()


def joined(rows, least):
    """Brute force: (id, links, component) for usable rows with distinct ids."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    part = list(range(len(ids)))
    for _ in ids:
        part = [min([part[i], *(part[j] for j in np.flatnonzero(close[i]))]) for i in range(len(ids))]
    return sorted((ids[i], int(close[i].sum()), min(ids[j] for j in range(len(ids)) if part[j] == part[i])) for i in range(len(ids)))


@pytest.mark.parametrize("chunk", [16_384, 40])
def test_links_and_components(spark, chunk, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 48))
    rows = []
    for c in centres:
        for _ in range(rng.integers(1, 25)):
            rows.append(c + rng.normal(0, rng.choice([0.05, 0.2, 0.34]), 48))
    rows += [rows[0]] * 5
    ids = rng.permutation(len(rows))
    rows = [(int(i), [float(np.float32(v)) for v in x]) for i, x in zip(ids, rows)]
    links = vector_dups.links
    monkeypatch.setattr(vector_dups, "links", lambda *a, **k: links(*a, **k, chunk=chunk))
    got = vector_dups.near_duplicates(frame(spark, rows), "vec_id", "embedding", least=0.9)
    assert tuples(got, "id", "n_links", "component_id") == sorted(joined(rows, 0.9), key=repr)
    assert got.filter("kept <> (id = component_id)").isEmpty()


def test_odd_vectors_link_with_nothing(spark):
    rows = [
        (1, None), (2, [0.0, 0.0]), (3, [NAN, 1.0]), (4, [None, 1.0]), (5, [1.0, 0.0]), (6, [2.0, 0.0]),
        (7, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (8, [-0.0, 1.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, []),
    ]
    got = vector_dups.near_duplicates(frame(spark, rows), "vec_id", "embedding")
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 7, 10)] + [(None, 0, None, True)]
    linked = [(5, 1, 5, True), (6, 1, 5, False), (8, 2, 8, True), (9, 2, 8, False), (9, 2, 8, False)]
    assert tuples(got, "id", "n_links", "component_id", "kept") == sorted(alone + linked, key=repr)
