"""Sets of ids as bitmaps against Python's sets."""

import random

import pytest
from pyspark.sql import functions as F

from docquarry.operators import idsets

KEYS = ["split", "qid"]


@pytest.fixture(scope="module")
def sets():
    rng = random.Random(3)
    edge = [-65_536, -32_769, -32_768, -32_767, -1, 0, 1, 32_767, 32_768, 32_769, 65_536, 65_537]
    found = {("s", q): set(rng.sample(edge, 6) + rng.choices(range(-10**5, 10**5), k=20)) for q in range(8)}
    found["t", 1] = set(found["s", 1])
    found["t", 2] = set(range(1, 40_000))
    found["t", 3] = found["t", 2] - {39_999}
    return found


@pytest.fixture(scope="module")
def blocks(spark, sets):
    rows = [(*key, i) for key, ids in sets.items() for i in ids] + [("s", 1, min(sets["s", 1])), ("n", 1, None)]
    return idsets.id_blocks(spark.createDataFrame(rows, "split string, qid long, doc_id long"), KEYS).cache()


def test_sizes_and_ids(blocks, sets):
    assert {(r.split, r.qid): r.n_ids for r in idsets.sizes(blocks, KEYS).collect()} == {k: len(v) for k, v in sets.items()}
    small = blocks.filter("split = 's'").withColumn("list", idsets.ids_of(F.col("ids"), F.col("block")))
    for key, ids in sets.items():
        if key[0] == "s":
            rows = small.filter((F.col("qid") == key[1])).collect()
            assert sorted(i for r in rows for i in r.list) == sorted(ids)
            assert all(idsets.block_of(i) == r.block for r in rows for i in r.list)


@pytest.mark.parametrize("cutoff", [-70_000, -32_768, -1, 0, 1, 5_000, 32_768, 32_769, 10**6])
def test_cutoffs(blocks, sets, cutoff):
    kept = idsets.sizes(idsets.up_to(blocks, KEYS, cutoff), KEYS).collect()
    want = {k: sum(i <= cutoff for i in v) for k, v in sets.items()}
    assert {(r.split, r.qid): r.n_ids for r in kept} == {k: n for k, n in want.items() if n}


def test_unions_and_equal_sets(blocks, sets):
    whole = idsets.sizes(idsets.united(blocks, ["split"]), ["split"]).collect()
    assert {r.split: r.n_ids for r in whole} == {
        s: len(set().union(*(v for k, v in sets.items() if k[0] == s))) for s in ("s", "t")
    }
    digests = {(r.split, r.qid): r.digest for r in idsets.set_digests(blocks, KEYS).collect()}
    for a in sets:
        for b in sets:
            assert (digests[a] == digests[b]) == (sets[a] == sets[b])
