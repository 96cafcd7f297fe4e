from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardwatch import functions as fn


def one(spark, column, **values):
    base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return base.select(column).first()[0]


def test_ratio_rounds_and_survives_zero(spark):
    assert one(spark, fn.ratio("a", "b"), a=1, b=3) == 0.3333
    assert one(spark, fn.ratio("a", "b", scale=100), a=1, b=3) == 33.3333
    assert one(spark, fn.ratio("a", "b"), a=1, b=0) is None


def test_percent_rounds_half_up_in_decimal(spark):
    assert one(spark, fn.percent("r", 1), r=0.0045) == Decimal("0.5")
    assert one(spark, fn.percent("r", 2), r=0.33335) == Decimal("33.34")
    assert one(spark, fn.decimal_round("r", 2), r=1.005) == Decimal("1.01")


def test_percent_agrees_with_decimal_arithmetic(spark):
    rates = spark.range(20_001).select((F.col("id") / 10_000).alias("r"))
    for rate, pct in rates.select("r", fn.percent("r")).collect():
        exact = (Decimal(str(rate)) * 100).quantize(Decimal("0.1"), rounding="ROUND_HALF_UP")
        assert pct == exact


def test_labels(spark):
    assert one(spark, fn.period_label("y", "m"), y=2024, m=5) == "2024-05"
    assert one(spark, fn.period_label("y", "m"), y=2024, m=12) == "2024-12"
    assert one(spark, fn.period_label("y", F.lit(None)), y=2024) is None
    assert one(spark, fn.full_name("l", "f"), l="Doe", f="Jo") == "Doe, Jo"
    assert one(spark, fn.full_name("l", F.lit(None)), l="Doe") is None
    assert one(spark, fn.day_name("d"), d=1) == "Sun"
    assert one(spark, fn.day_name("d"), d=7) == "Sat"
    assert one(spark, fn.day_name("d"), d=8) is None
    assert one(spark, fn.cluster_label("c", "n"), c=5, n=7873) == "Cluster 5 — 7,873 crimes"


@pytest.mark.parametrize(
    "text, key",
    [(" 011 ", "011"), ("\t8\n", "8"), ("", "UNKNOWN"), (" \t ", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_route_key(spark, text, key):
    assert one(spark, fn.route_key(F.lit(text).cast("string"))) == key


@pytest.mark.parametrize(
    "count, threshold, band",
    [
        (100, 100, "LOW"),
        (149, 100, "LOW"),
        (150, 100, "MEDIUM"),
        (199, 100, "MEDIUM"),
        (200, 100, "HIGH"),
        (299, 100, "HIGH"),
        (300, 100, "CRITICAL"),
        (7, 5, "LOW"),
        (9, 0, "LOW"),
        (9, -1, "LOW"),
    ],
)
def test_severity(spark, count, threshold, band):
    assert one(spark, fn.severity("n", threshold), n=count) == band


def test_alert_id_follows_from_key_and_event(spark):
    first = one(spark, fn.alert_id("k", "e"), k="8", e=17)
    assert first == one(spark, fn.alert_id("k", "e"), k="8", e=17)
    assert first != one(spark, fn.alert_id("k", "e"), k="8", e=18)
    assert first.startswith("ALERT-") and len(first) <= 50


def test_share_of_total_and_bubble_size(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (12,)], "n long")
    shares = [r[0] for r in df.select(fn.share_of_total("n")).collect()]
    assert sorted(shares) == [6.2, 6.2, 12.5, 75.0]  # 6.25 goes to the even digit
    assert max(r[0] for r in df.select(fn.bubble_size("n")).collect()) == 50.0
