from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import frame
from tillstream.operators.asof import latest_within
from tillstream.operators.evolve import conform, ensure_columns
from tillstream.operators.keyed import first_per_key, insert_if_absent
from tillstream.operators.sampling import sample_ids
from tillstream.schemas import CUSTOMER_COUNTRY_COLUMNS, CUSTOMERS, columns, INT, STRING

START = datetime(2024, 1, 1)


def brute_force(events, readings, tolerance):
    answers = []
    for n, key, at in events:
        best = None
        for k, ts, value in readings:
            if key is None or at is None or k != key or ts is None or ts > at:
                continue
            if best is None or (ts, value) > best:
                best = (ts, value)
        if best and at - best[0] > timedelta(seconds=tolerance):
            best = None
        answers.append((n, best[1] if best else None))
    return answers


@pytest.mark.parametrize("tolerance, spread", [(300, 3000), (7, 60), (3600, 200_000), (100_000, 400_000)])
@pytest.mark.parametrize("rows_per_task", [1_000_000, 5])
def test_asof_equals_brute_force(spark, tolerance, spread, rows_per_task):
    draw = random.Random(tolerance)

    def moment():
        return START + timedelta(microseconds=draw.randrange(spread * 4) * 250_000)

    keys = ["hot"] * 6 + ["a", "b", None]
    events = [(n, draw.choice(keys), moment() if n % 17 else None) for n in range(250)]
    # A third of the events are at one moment of one key.
    events += [(1000 + n, "hot", START + timedelta(seconds=spread // 2)) for n in range(120)]
    readings = [(draw.choice(keys), moment(), draw.randrange(100)) for _ in range(120)]
    readings += [("hot", START + timedelta(seconds=spread // 2), v) for v in (3, 9, 4)]
    readings += [("a", None, 5)]
    readings += [(k, at - timedelta(seconds=tolerance), 50) for _, k, at in events[1:20] if at]
    left = frame(spark, events, "n int, k string, at timestamp_ntz").repartition(6)
    right = frame(spark, readings, "k string, ts timestamp_ntz, value int")
    got = latest_within(left, right, "k", "at", "ts", tolerance, rows_per_task)
    assert got.columns == ["n", "k", "at", "reading"]
    answers = sorted((r.n, r.value) for r in got.select("n", "reading.value").collect())
    assert answers == sorted(brute_force(events, readings, tolerance))


def test_first_write_of_a_key_wins(spark, rows):
    incoming = frame(
            spark,
        [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "y"), ("b", 5, "x"), (None, 0, "none"), ("c", 1, "known")],
        "k string, sent int, v string",
    )
    assert rows(first_per_key(incoming, "k", ["sent"])) == [("a", 1, "early"), ("b", 5, "x"), ("c", 1, "known")]
    existing = frame(spark, [("c", "old"), ("z", "old"), (None, "old")], "k string, v string")
    for known_size in (None, 6):
        fresh = insert_if_absent(existing, incoming, "k", ["sent"], known_size)
        assert fresh.columns == ["k", "sent", "v"]
        assert rows(fresh) == [("a", 1, "early"), ("b", 5, "x")]


def test_ensure_columns_adds_only_what_is_absent(spark):
    df = frame(spark, [("c1", "Oslo", "NO")], "customer_id string, customer_city string, Country_Code string")
    wide = ensure_columns(df, CUSTOMER_COUNTRY_COLUMNS)
    assert wide.columns == ["customer_id", "customer_city", "Country_Code", "country_name", "currency", "population", "region", "lat", "lon"]
    assert ensure_columns(wide, CUSTOMER_COUNTRY_COLUMNS).columns == wide.columns
    assert wide.first().Country_Code == "NO"
    assert conform(df, CUSTOMERS).columns == CUSTOMERS.names
    assert conform(df, columns(customer_city=STRING, n=INT)).dtypes == [("customer_city", "string"), ("n", "int")]


def test_sample_is_repeatable_with_a_seed(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    one = {r.id for r in sample_ids(ids, "id", 50, "s").collect()}
    two = {r.id for r in sample_ids(ids.repartition(7), "id", 50, "s").collect()}
    assert one == two and len(one) == 50
    assert sample_ids(ids, "id", 10).count() == 10
    assert one != {r.id for r in sample_ids(ids, "id", 50, "t").collect()}
