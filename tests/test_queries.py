"""Every registered query against its SQL oracle."""

from __future__ import annotations

import re

import pytest
from check import differences

import __spark_entry__ as entry_points

SMALL = "/root/testdata/sf0.001"
OWN = [n for n in entry_points.queries() if not re.fullmatch(r"op\d+_.*|pipeline", n)]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, name):
    rows, problem = differences(spark, SMALL, name)
    assert not problem


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["order_date", "total_orders"]
