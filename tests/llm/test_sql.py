"""Queries against the SQL that states the same result."""

from __future__ import annotations

import pytest
from check import differences
from given import SMALL

import __spark_entry__ as entry_points
from tillstream.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    rows, problem = differences(spark, SMALL, name)
    assert rows and not problem


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry_points.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in queries.queries()) == list(range(1, 14))
