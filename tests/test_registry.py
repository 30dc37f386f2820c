"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry
from compare import connect, difference
from conftest import SMALL
from docquarry.plans.workspace import workspace
from docquarry.registry.oracle import oracle_sql
from docquarry.registry.queries import queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SMALL).toPandas()
    assert difference(got, duck.execute(SQL[name]).df()) is None
    assert len(got) > 0


def test_entry(spark):
    assert entry(spark).columns == ["method", "split", "qid", "rank", "doc_id", "score"]


def test_workspace_is_reused_and_bound_to_the_files(spark, tmp_path):
    import shutil

    assert workspace(spark, SMALL) is workspace(spark, SMALL)
    for name in ("documents", "benchmark"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = workspace(spark, str(tmp_path))
    (tmp_path / "benchmark.parquet").touch()
    shutil.copy("/root/testdata/sf0.01/documents.parquet", tmp_path / "new.parquet")
    (tmp_path / "documents.parquet").chmod(0o644)
    (tmp_path / "documents.parquet").write_bytes((tmp_path / "new.parquet").read_bytes())
    assert workspace(spark, str(tmp_path)) is not first
