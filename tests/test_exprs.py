"""Layer 1: semantics of the column helpers, one test per trap."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.functions import exprs as X


def one_col(spark, values, typ):
    if typ == "double":
        values = [None if v is None else float(v) for v in values]
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_age_bins_right_closed(spark):
    vals = [17, 18, 25, 25.5, 26, 35, 36, 65, 66, 100, 101, None]
    got = [r[0] for r in one_col(spark, vals, "double").select(X.age_group("x")).collect()]
    want = pd.cut(pd.Series(vals, dtype="float"), bins=X.AGE_EDGES, labels=X.AGE_LABELS)
    want = [None if pd.isna(v) else str(v) for v in want]
    assert got == want


def test_discount_bins(spark):
    vals = [-5, 0, 0.01, 10, 10.01, 20, 20.01, 100, 120, None]
    got = [r[0] for r in one_col(spark, vals, "double").select(X.discount_bucket("x")).collect()]
    want = pd.cut(pd.Series(vals, dtype="float"), bins=X.DISCOUNT_EDGES, labels=X.DISCOUNT_LABELS)
    assert got == [None if pd.isna(v) else str(v) for v in want]


def test_probability_bins(spark):
    vals = [0, 0.3, 0.3001, 0.6, 0.6001, 1]
    got = [r[0] for r in one_col(spark, vals, "double").select(X.churn_risk_bin("x")).collect()]
    assert got == ["Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk"]


def test_idle_risk_flag(spark):
    vals = [180, 181, 365, 366, None]
    got = [r[0] for r in one_col(spark, vals, "int").select(X.idle_risk_flag("x")).collect()]
    assert got == ["Low Risk", "Medium Risk", "Medium Risk", "High Risk", "Low Risk"]


def test_rfm_segment_thresholds(spark):
    vals = [3, 4, 5, 6, 7, 9, 10, 12, 13, 15]
    got = [r[0] for r in one_col(spark, vals, "int").select(X.rfm_segment("x")).collect()]
    assert got == ["Lost", "Lost", "At Risk", "At Risk", "Potential Loyalists",
                   "Potential Loyalists", "Loyal Customers", "Loyal Customers", "Champions",
                   "Champions"]


def test_strip_and_title_match_python(spark):
    vals = ["  premium\t", "o'neil high-value x2y", "MIDDLE EAST", " male ", "élan vital", None]
    got = [r[0] for r in one_col(spark, vals, "string").select(X.normalise_text("x")).collect()]
    assert got == [None if v is None else v.strip().title() for v in vals]


def test_clip_keeps_null(spark):
    got = [r[0] for r in one_col(spark, [-5, 50, 120, None], "int")
           .select(X.clip_keep_null("x", 0, 100)).collect()]
    assert got == [0, 50, 100, None]


@pytest.mark.parametrize("num,den,digits,mode,want", [
    (1, 8, 2, "half_up", 0.13), (1, 8, 2, "half_even", 0.12), (3, 8, 2, "half_even", 0.38),
    (267500, 100000, 2, "half_up", 2.68), (-1, 8, 2, "half_up", -0.13), (5, 0, 2, "half_up", None),
    (2, 3, 0, "half_up", 1.0), (7, 2, 0, "half_even", 4.0), (5, 2, 0, "half_even", 2.0)])
def test_round_ratio_exact_ties(spark, num, den, digits, mode, want):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    assert df.select(X.round_ratio(F.col("n"), F.col("d"), digits, mode)).first()[0] == want


@pytest.mark.parametrize("mode", ["half_up", "half_even"])
def test_round_ratio_beyond_bigint(spark, mode):
    """Money totals at 100 TB pass 2**63 cents; the quotient must not wrap."""
    df = spark.createDataFrame([(Decimal(10) ** 20, Decimal(10) ** 20 * 3 + 5)], "n decimal(38,0), m decimal(38,0)")
    row = df.select(X.round_ratio("n", F.lit(100), 2, mode), X.round_ratio("m", F.lit(1000), 2, mode)).first()
    assert row[0] == 1e18 and row[1] == pytest.approx(3e17)


def test_title_case_of_a_very_long_run(spark):
    df = spark.createDataFrame([("a" * 1_100_000,)], "x string")
    assert df.select(X.title_case("x")).first()[0] == "A" + "a" * 1_099_999


def test_date_parts(spark):
    d = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 1, 6),),
                               (dt.date(2024, 1, 7),)], "d date")
    rows = d.select(F.weekofyear("d"), X.is_weekend("d"), X.weekend_label("d"), X.day_name("d"),
                    X.month_name("d"), X.month_key("d")).collect()
    assert rows[0][0] == 1                                   # ISO week (P6)
    assert [r[1] for r in rows] == [False, True, True]       # Mon=0 .. Sun=6 (P5)
    assert [r[2] for r in rows] == ["Weekday", "Weekend", "Weekend"]
    assert rows[1][3] == "Saturday" and rows[0][4] == "Dec" and rows[0][5] == "2024-12"


def test_decimal_money_cents(spark):
    df = spark.createDataFrame([(Decimal("12.34"),)], "x decimal(15,2)")
    assert df.select(X.cents("x")).first()[0] == 1234


def test_safe_divide_blank_on_zero(spark):
    """BI DIVIDE gives blank on a zero denominator (Spark 4 ANSI would raise)."""
    df = spark.createDataFrame([(5, 0), (6, 3)], "n int, d int")
    assert [r[0] for r in df.select(X.mean_double(F.col("n"), F.col("d"))).collect()] == [None, 2.0]


def test_null_customer_id_is_an_orphan(spark):
    """Pandas ``~isin`` treats a NULL id as absent; so does the anti join."""
    from basketry.operators import quality
    t = spark.createDataFrame([("t1", "c1"), ("t2", None), ("t3", "c9")],
                              "transaction_id string, customer_id string")
    c = spark.createDataFrame([("c1",)], "customer_id string")
    got = {r.transaction_id for r in quality.orphan_transactions(t, c).collect()}
    assert got == {"t2", "t3"}
