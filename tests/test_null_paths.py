"""LEFT JOIN / NULL paths on a hand-made fixture, Spark operators vs the same
oracle SQL in DuckDB: customers without transactions, NULL attributes, an
orphan and a NULL-id transaction, a month with no sales."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from basketry.operators import bi, features, reports
from basketry.plans.oracle_queries import SQL
from basketry.plans.registry import SNAPSHOT, finalize
from basketry.sources.readers import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA
from tests.oracle_check import compare

D = dt.date
CUSTOMERS = [
    ("CUST0000001", 30, "Male", "ASIA", "Premium", "a@x", D(1995, 1, 1), 100, 0),
    ("CUST0000002", 40, "Female", "EUROPE", "Occasional", "b@x", D(1995, 2, 1), 200, 1),   # no txn
    ("CUST0000003", None, "Other", "ASIA", "Regular", "c@x", D(1995, 3, 1), None, None),
    ("CUST0000004", 55, "Male", "AFRICA", "New", "d@x", D(1995, 4, 1), 50, 1),            # no txn
]


def _t(i, cust, day, cat, ch, amt, disc, qty, rating, ret, pay):
    amt = Decimal(amt)
    disc = None if disc is None else Decimal(disc)
    fin = amt if disc is None else (amt * (1 - disc / 100)).quantize(Decimal("0.01"))
    return (f"T{i}", cust, day, cat, ch, amt, disc, fin, qty, rating, ret, pay)


TRANSACTIONS = [
    _t(1, "CUST0000001", D(2001, 1, 5), "SMALL", "Online", "10.00", "0.00", 2, 5, 0, "UPI"),
    _t(2, "CUST0000001", D(2001, 3, 10), "LARGE", "In-Store", "20.00", "10.00", 1, None, 1, "Cash"),
    _t(3, "CUST0000003", D(2001, 3, 11), "SMALL", "Phone", "7.50", None, 3, 3, 0, "Wallet"),
    _t(4, "CUST0000009", D(2001, 4, 1), "LARGE", "Online", "99.99", "25.00", 1, 4, 0, "UPI"),
    _t(5, None, D(2001, 4, 2), "SMALL", "Mobile App", "5.00", "5.00", 4, 2, 1, "Cash"),
]

CASES = {
    "kpi_summary": lambda c, t: reports.kpi_summary(c, t),
    "segment_analysis": lambda c, t: reports.segment_analysis(c, t),
    "regional_performance": lambda c, t: reports.regional_performance(c, t),
    "churn_risk_flag": lambda c, t: reports.churn_risk_flags(c, t, SNAPSHOT),
    "customer_activity": lambda c, t: features.customer_activity(c, t, SNAPSHOT),
    "customer_360_view": lambda c, t: features.customer_360_view(c, t),
    "top20_customers": lambda c, t: reports.top_customers_ltv(c, t, 20),
    "cohort_first_purchase": lambda c, t: reports.cohort_first_purchase(t),
    "category_performance": lambda c, t: reports.category_performance(t),
    "mom_growth": lambda c, t: bi.mom_growth(t),
    "revenue_by_segment_all": lambda c, t: bi.revenue_by_segment_all(c, t),
    "rfm_ntile": lambda c, t: features.rfm_ntile_scores(features.rfm_sql_base(t, SNAPSHOT)),
    "bi_measures": lambda c, t: bi.bi_measures(c, t),
    "churn_by_region": lambda c, t: bi.churn_by_region(c),
}


@pytest.fixture(scope="module")
def frames(spark):
    c = spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA)
    t = spark.createDataFrame(TRANSACTIONS, TRANSACTION_SCHEMA)
    con = duckdb.connect()
    con.register("customers_pd", c.toPandas())
    con.register("transactions_pd", t.toPandas())
    con.execute("CREATE TABLE customers AS SELECT * REPLACE (CAST(join_date AS DATE) AS join_date) "
                "FROM customers_pd")
    con.execute("CREATE TABLE transactions AS SELECT * REPLACE ("
                "CAST(transaction_date AS DATE) AS transaction_date, "
                "CAST(amount AS DECIMAL(15,2)) AS amount, "
                "CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent, "
                "CAST(final_amount AS DECIMAL(15,2)) AS final_amount) FROM transactions_pd")
    return c, t, con


@pytest.mark.parametrize("name", sorted(CASES))
def test_null_paths_match_oracle(frames, name):
    c, t, con = frames
    body = SQL[name].strip()
    sql = ("WITH _none AS (SELECT 1)\n" + body) if body.startswith(",") else body
    problems, _ = compare(finalize(CASES[name](c, t)), con, sql)
    assert not problems, problems


def test_customer_without_transactions_counts_once(frames):
    c, t, _ = frames
    rows = {r.segment: r for r in reports.segment_analysis(c, t).collect()}
    assert rows["Occasional"].total_transactions == 0 and rows["Occasional"].total_revenue is None
    flags = {r.customer_id: r.churn_risk_flag
             for r in reports.churn_risk_flags(c, t, SNAPSHOT).collect()}
    assert flags["CUST0000002"] == "Low Risk"          # NULL idle days fall through (P14)
    mom = {r.month: r for r in bi.mom_growth(t).collect()}
    assert mom[D(2001, 3, 1)].prev_month_revenue is None   # February had no sales (J8)
