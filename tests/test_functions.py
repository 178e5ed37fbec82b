from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tillstream.functions import clock, money


def test_share_text_prints_like_percent_1f(spark):
    draw = random.Random(7)
    pairs = [(f, r) for r in (1, 3, 8, 40, 400, 800, 2000, 4000) for f in range(0, r + 1, max(r // 200, 1))]
    pairs += [(draw.randrange(1, 10**6), draw.randrange(1, 10**7)) for _ in range(20_000)]
    pairs += [(0, 0), (5, 0)]
    df = spark.createDataFrame(pairs, "f bigint, r bigint")
    got = df.select("f", "r", money.share_text(F.col("f"), F.col("r")).alias("t")).collect()
    wrong = [(x.f, x.r, x.t) for x in got if x.t != f"{x.f / max(x.r, 1) * 100:.1f}"]
    assert wrong == []


def test_exact_mean_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame(
        [("a", Decimal("0.01")), ("a", Decimal("0.02")), ("b", Decimal("-0.01")), ("b", Decimal("-0.02")), ("c", None)],
        "k string, v decimal(18,2)",
    )
    got = {r.k: r.m for r in df.groupBy("k").agg(money.mean_of(F.col("v"), 2, scale=2).alias("m")).collect()}
    assert got == {"a": Decimal("0.02"), "b": Decimal("-0.02"), "c": None}


def test_percentage_of_nothing_is_null(spark):
    got = spark.range(1).select(money.percentage(F.lit(0), F.lit(0)).alias("p")).first().p
    assert got is None


def test_freight_is_a_tenth(spark):
    df = spark.createDataFrame([(Decimal("12.34"),), (Decimal("0.05"),)], "p decimal(18,2)")
    assert [r.f for r in df.select(money.freight(F.col("p")).alias("f")).collect()] == [Decimal("1.23"), Decimal("0.01")]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(datetime(2024, 3, 10, 0, 30), datetime(2024, 3, 10, 2, 30, 0, 5))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        got = df.select(
            clock.micros_between(F.col("a"), F.col("b")).alias("m"),
            clock.hour_start(F.col("b")).alias("h"),
            clock.day_start(F.col("b")).alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got.m == 7_200_000_005
    assert (got.h, got.d) == (datetime(2024, 3, 10, 2), datetime(2024, 3, 10))


def test_exact_mean_of_very_many(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from tillstream.functions.money import exact_mean

    # 0.005 - 1e-12 rounds down, whatever digits a decimal quotient would keep.
    n = 10**11
    data = [(Decimal(n) / 200 - Decimal("0.10"), n), (Decimal(n) / 200, n), (Decimal("-0.05"), 10), (None, 3), (Decimal(1), 0)]
    df = spark.createDataFrame(data, "t decimal(30,2), n long")
    got = [r[0] for r in df.select(exact_mean(F.col("t"), F.col("n"), 2)).collect()]
    assert got == [Decimal("0.00"), Decimal("0.01"), Decimal("-0.01"), None, None]
