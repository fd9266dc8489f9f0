import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martkit.session import build_session, drop_staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="martkit-test-")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted as text so that nulls do not matter."""
    cols = order or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
