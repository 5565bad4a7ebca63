import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tidemart.session import build, work_database  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("shared")
    s = build("tests", "local[4]", spark_driver_memory="4g", spark_checkpoint_dir=str(base),
              spark_sql_warehouse_dir=str(base / "warehouse"))
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def db(spark):
    return work_database(spark, "test")


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
