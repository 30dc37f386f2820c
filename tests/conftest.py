import os
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ["PYTHONPATH"] = os.pathsep.join(sys.path[:2])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("docquarry-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change a setting for the length of a ``with`` block."""

    @contextmanager
    def change(key, value):
        spark.conf.set(key, str(value))
        try:
            yield
        finally:
            spark.conf.unset(key)

    return change


def tuples(df, *columns):
    """Sorted rows, floats rounded to six digits."""
    rows = df.select(*columns).collect() if columns else df.collect()
    plain = [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows]
    return sorted(plain, key=repr)
