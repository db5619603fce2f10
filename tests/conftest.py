import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weirflow.lineage import drop_work_folders  # noqa: E402
from weirflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_work_folders(session)
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a long, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def values(df, *columns):
    """Rows as sorted tuples, nulls first."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])
