"""Physical-plan properties that matter at scale (checked on sf0.001 plans)."""

import re

import pytest

from basketry.plans.registry import CACHE_SOURCES, queries
from basketry.sources import tables as T

SF = "/root/testdata/sf0.001"
NO_CROSS = ["kpi_summary", "kpi_customer_weighted", "bi_measures", "segment_analysis",
            "regional_performance", "churn_risk_flag", "top20_customers", "eval_roc",
            "cohort_first_purchase", "customer_360_view", "mom_growth", "quality_report"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_CROSS)
def test_no_cross_join(spark, name):
    p = plan(queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_transactions_scan_reads_only_needed_columns(spark):
    df = T.transactions(spark, SF).groupBy("channel").count()
    p = plan(df)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution()
                         .executedPlan().toString()) or re.findall(r"struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem, p
    for s in lineitem:
        assert "l_shipdate" not in s and "l_tax" not in s and "l_extendedprice" not in s


def test_customer_reports_aggregate_before_the_join(spark):
    """Transactions reach the customer join as per-customer partial aggregates."""
    from basketry.operators import reports
    c, t = T.customers(spark, SF), T.transactions(spark, SF)
    p = plan(reports.segment_analysis(c, t))
    join = p.index("Join")
    # the transaction side below the join is aggregated by customer_id
    assert "HashAggregate(keys=[customer_id" in p[join:]


def test_explicit_broadcasts_are_fixed_size(spark):
    import inspect
    from basketry.sources import tables
    src = inspect.getsource(tables)
    assert src.count("F.broadcast(") == 2          # nation and region only


def test_registered_query_scans_only_its_columns(spark):
    """Sources are not cached by default, so pruning reaches the scan of a registered query."""
    assert CACHE_SOURCES is False
    p = plan(queries()["category_performance"](spark, SF))
    lineitem = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "l_quantity" in s]
    assert lineitem and not any("l_suppkey" in s for s in lineitem), p


ML = ("kmeans", "cluster", "pca", "churn_model", "churn_scores", "feature_imp", "segment_gen1",
      "churn_gen1")


def test_no_data_sized_single_partition_exchange(spark):
    """At sf0.001 (150 customers, 6,000 transactions) every single-partition
    exchange of every relational query carries only a handful of rows:
    partial global aggregates, range-partition offsets or per-dimension rows."""
    from tests.plan_shapes import single_partition_rows
    worst = {name: single_partition_rows(fn(spark, SF))
             for name, fn in queries().items() if not name.startswith(ML)}
    assert max(worst.values()) <= 64, sorted(worst.items(), key=lambda kv: -kv[1])[:5]


def test_keep_first_dedup_combines_map_side(spark):
    """C1 is an aggregation with a partial (map-side) minimum, not a row_number
    window: a key repeated a billion times leaves one row per map task."""
    from basketry.operators import clean
    df = spark.createDataFrame([("k", i, i * 2) for i in range(1000)] + [("z", 0, 1)],
                               "key string, ingest_seq int, v int")
    out = clean.dedup_first(df, "key", ["ingest_seq"])
    p = plan(out)
    assert "partial_min(struct(" in p and "Window" not in p
    exchange = next(line for line in p.splitlines() if "partial_min(" in line)
    assert exchange.count("ingest_seq") <= 2       # the row is held once
    assert {(r.key, r.v) for r in out.collect()} == {("k", 0), ("z", 1)}
