from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from tillstream.sources.tables import Lake

    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, NULLs first."""

    def sorted_rows(df):
        return sorted(
            (tuple(r) for r in df.collect()),
            key=lambda row: [(v is not None, str(v)) for v in row],
        )

    return sorted_rows


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
