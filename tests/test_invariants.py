"""Layer 3: the reference's own test invariants plus structural checks."""

import pytest
from pyspark.sql import functions as F

from basketry.plans.registry import queries

SF = "/root/testdata/sf0.001"
VALID_SEGMENTS = {"Premium", "Regular", "Occasional", "New"}
RFM_SEGMENTS = {"Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost"}


def test_cleaned_customers(inputs):
    c = inputs.dirty_customers_clean
    assert c.where(F.col("customer_id").isNull()).count() == 0
    assert c.groupBy("customer_id").count().where("count > 1").count() == 0
    assert c.where((F.col("age") < 18) | (F.col("age") > 100)).count() == 0
    assert c.where(F.col("tenure_days") < 0).count() == 0
    assert {r[0] for r in c.select("segment").distinct().collect()} <= VALID_SEGMENTS
    assert "age_group" in c.columns


def test_cleaned_transactions(inputs):
    t = inputs.dirty_transactions_clean
    assert t.groupBy("transaction_id").count().where("count > 1").count() == 0
    assert t.where(F.col("revenue") <= 0).count() == 0
    assert t.where((F.col("discount_percent") < 0) | (F.col("discount_percent") > 100)).count() == 0
    assert t.where((F.col("rating") < 1) | (F.col("rating") > 5)).count() == 0
    assert {r[0] for r in t.select("is_returned").distinct().collect()} <= {0, 1}
    for col in ("year", "month", "quarter", "revenue"):
        assert col in t.columns


def test_rfm(inputs):
    r = inputs.rfm_scores
    for col in ("recency", "frequency", "monetary", "rfm_segment"):
        assert col in r.columns
    assert {x[0] for x in r.select("rfm_segment").distinct().collect()} <= RFM_SEGMENTS
    assert r.where(F.col("monetary") <= 0).count() == 0


def test_shares_sum_to_100(spark):
    q = queries()
    cat = q["category_performance"](spark, SF).agg(F.sum("revenue_share_pct")).first()[0]
    ch = q["channel_performance"](spark, SF).agg(F.sum("volume_share_pct")).first()[0]
    assert cat == pytest.approx(100, abs=0.05) and ch == pytest.approx(100, abs=0.05)


def test_weightings_differ(spark):
    """The SQL (transaction-weighted) churn rate is not the customer-weighted one."""
    q = queries()
    sql_rate = q["kpi_summary"](spark, SF).first()["churn_rate_pct"]
    kpis = {r.KPI: r.Value for r in q["kpi_customer_weighted"](spark, SF).collect()}
    assert sql_rate != kpis["Churn Rate (%)"]


def test_stratified_split_keeps_ratio(spark):
    s = queries()["stratified_split"](spark, SF)
    g = {(r.is_churned, r.split): r["count"] for r in s.groupBy("is_churned", "split").count().collect()}
    for cls in (0, 1):
        n = g.get((cls, "test"), 0) + g.get((cls, "train"), 0)
        assert g[(cls, "test")] == -(-n // 5)


def test_quality_report_flags_orphans(spark):
    rep = {r.check: r for r in queries()["quality_report"](spark, SF).collect()}
    assert rep["orphan_transactions"].violations > 0 and not rep["all_checks"].passed
    assert rep["duplicate_transaction_id"].violations == 0
