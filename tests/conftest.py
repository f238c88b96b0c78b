import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewater.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # small inputs keep their partitions, so that the steps between partitions are exercised
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.ui.enabled": "false"}
    session = build_session("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted tuples of a frame, NULLs last."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])

    return collect


@pytest.fixture
def plan_of():
    return lambda df: df._jdf.queryExecution().toString()
