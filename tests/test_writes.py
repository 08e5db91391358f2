"""Clustered and swapped writes, the incremental refresh, scan counts, key-first orphans, report order."""

import datetime as dt
import glob
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import quality
from basketry.plans.registry import queries
from basketry.sources import writers
from basketry.streaming import refresh
from tests.plan_shapes import _walk, exchanges

SF = "/root/testdata/sf0.001"


def folder():
    return tempfile.mkdtemp(prefix="basketry-test-")


def files(path):
    return sorted(glob.glob(f"{path}/**/part-*", recursive=True))


# ------------------------------------------------------------ writes
def test_partitioned_writes_have_as_many_files_as_rows_need(spark):
    """One partition holds a third of the rows; 40 tasks write 12 + 3 files, not 40 x 13."""
    rows = [(i, 2020, 1 + i % 12 if i % 3 else 1) for i in range(3000)] + [(-1, None, 5)]
    df = spark.createDataFrame(rows, "id long, year int, month int").repartition(40)
    d = folder()
    path = writers.write_table(df, d, "t", partition_by=["year", "month"], rows_per_file=400)
    counts = {}
    for i, y, m in rows:
        counts[y, m] = counts.get((y, m), 0) + 1
    found = {}
    for f in files(path):
        found[os.path.dirname(f)] = found.get(os.path.dirname(f), 0) + 1
    assert len(found) == len(counts)
    assert all(n <= max(-(-c // 400) for c in counts.values()) for n in found.values())
    assert len(files(path)) <= sum(-(-c // 400) for c in counts.values())
    back = spark.read.parquet(path)
    assert sorted((r.id, r.year, r.month) for r in back.collect() if r.year) == sorted(r for r in rows if r[1])
    assert back.count() == len(rows)


def test_a_failed_write_leaves_the_old_table(spark):
    d = folder()
    writers.write_table(spark.range(10), d, "t")
    broken = spark.range(5).withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        writers.write_table(broken, d, "t")
    assert spark.read.parquet(f"{d}/t").count() == 10
    assert os.listdir(d) == ["t"]
    # a table may be replaced by one computed from itself
    writers.write_table(spark.read.parquet(f"{d}/t").where("id < 4"), d, "t")
    assert spark.read.parquet(f"{d}/t").count() == 4 and os.listdir(d) == ["t"]


def test_empty_tables_are_written(spark):
    d = folder()
    writers.write_table(spark.createDataFrame([], "id long, year int"), d, "t", partition_by=["year"])
    assert os.path.isdir(f"{d}/t")


# ------------------------------------------------------------ refresh
def daily(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), c, "Online", float(v), n, float(v)) for d, c, v, n in rows],
                                 "transaction_date date, product_category string, channel string, revenue double, transactions long, avg_value double")


def test_only_changed_days_are_rewritten(spark):
    d = folder() + "/out"
    refresh.replace_days(daily(spark, [(1, "a", 1, 1), (1, "b", 2, 1), (2, "a", 3, 1), (3, "a", 4, 2)]), d)
    before = {f: os.stat(f).st_mtime_ns for f in files(d)}
    assert len(before) == 3                                    # a file a day
    refresh.replace_days(daily(spark, [(2, "b", 9, 1), (2, "a", 5, 2), (4, "a", 1, 1)]), d)
    after = {f: os.stat(f).st_mtime_ns for f in files(d)}
    for day in (1, 3):
        assert {f: t for f, t in after.items() if f"01-0{day}" in f} == {f: t for f, t in before.items() if f"01-0{day}" in f}
    got = sorted((r.transaction_date.day, r.product_category, r.revenue) for r in spark.read.parquet(d).collect())
    assert got == [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 5.0), (2, "b", 9.0), (3, "a", 4.0), (4, "a", 1.0)]
    # running a batch again changes nothing
    refresh.replace_days(daily(spark, [(2, "b", 9, 1), (2, "a", 5, 2), (4, "a", 1, 1)]), d)
    assert sorted((r.transaction_date.day, r.product_category, r.revenue) for r in spark.read.parquet(d).collect()) == got


# ------------------------------------------------------------ scans
def line_scans(df):
    """Scans of the line table that an executed plan really ran."""
    df.write.format("noop").mode("overwrite").save()
    return sum("lineitem" in n.toString() and "Scan" in n.getClass().getSimpleName() for n in _walk(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("name", ["bi_measures", "mtd_revenue", "mom_growth"])
def test_one_scan_of_the_lines(spark, name):
    assert line_scans(queries()[name](spark, SF)) == 1


def test_executive_kpis_write_their_columns_once_and_scan_no_more(spark):
    seen = []
    real = type(spark.range(1)).checkpoint
    type(spark.range(1)).checkpoint = lambda self, *a, **b: (seen.append(self.columns), real(self, *a, **b))[1]
    try:
        df = queries()["kpi_summary"](spark, SF)
        assert line_scans(df) == 0
    finally:
        type(spark.range(1)).checkpoint = real
    assert len(seen) == 2 and "payment_method" not in sum(seen, [])


# ------------------------------------------------------------ orphans
def test_orphans_shuffle_no_rows(spark):
    """Only keys are exchanged, whether nothing or a third of the rows is orphaned."""
    customers = spark.createDataFrame([(f"C{i}",) for i in range(50)], "customer_id string")
    clean = spark.createDataFrame([(i, f"C{i % 50}") for i in range(2000)], "transaction_id long, customer_id string")
    dirty = clean.unionByName(spark.createDataFrame([(5000 + i, "gone" if i % 2 else None) for i in range(1000)], clean.schema))
    for df, want in ((clean, 0), (dirty, 1000)):
        out = quality.orphan_transactions(df, customers)
        assert out.count() == want
        assert exchanges(out) == []
    # beyond the broadcast a shuffle join gives the same
    assert quality.orphan_transactions(dirty, customers, broadcast_keys=0).count() == 1000


def test_quality_report_writes_only_the_columns_it_reads(spark):
    seen = []
    real = type(spark.range(1)).checkpoint

    def checkpoint(self, *a, **b):
        seen.append(self.columns)
        return real(self, *a, **b)

    type(spark.range(1)).checkpoint = checkpoint
    try:
        queries()["quality_report"](spark, SF).collect()
    finally:
        type(spark.range(1)).checkpoint = real
    wide = [c for c in seen if "transaction_id" in c]
    assert set(quality.TRANSACTION_RULE_COLUMNS) in [set(c) for c in wide] and "product_name" not in sum(seen[-3:], [])


# ------------------------------------------------------------ order
ORDER = {
    "monthly_revenue": ["year", "month"], "category_performance": ["-total_revenue", "product_category"],
    "channel_performance": ["-total_revenue", "channel"], "regional_performance": ["-total_revenue", "region"],
    "payment_methods": ["-total_revenue", "payment_method"], "segment_analysis": ["-total_revenue", "segment"],
    "weekend_weekday": ["-total_revenue", "day_type"],
    "channel_share": ["channel"], "segment_customers": ["segment"], "daily_revenue": ["transaction_date", "product_category", "channel"],
    "monthly_summary": ["year", "month", "month_name", "product_category"], "mom_growth": ["month"], "mtd_revenue": ["transaction_date"],
    "rfm_ntile": ["-rfm_total", "customer_id"], "cohort_first_purchase": ["cohort_month", "activity_month"],
    "category_chart": ["-revenue", "product_category"], "top20_customers": ["-lifetime_value", "customer_id"],
}


@pytest.mark.parametrize("name", sorted(ORDER))
def test_reports_come_in_order(spark, name):
    rows = queries()[name](spark, SF).collect()

    def key(r):
        out = []
        for c in ORDER[name]:
            v = r[c.lstrip("-")]
            out.append(-v if c.startswith("-") and isinstance(v, (int, float, Decimal)) else v)
        return out

    keys = [key(r) for r in rows]
    assert len(keys) > 1 and keys == sorted(keys)


# ------------------------------------------------------------ bad lines, keep-first, split
def test_broken_lines_are_counted_and_set_aside(spark):
    from basketry.sources import readers
    d = folder()
    with open(f"{d}/t.csv", "w") as f:
        f.write("customer_id,age,region,segment,join_date\nC1,30,N,Premium,2020-01-01\nC2,old,N,Premium,2020-01-01\nC3,40\nC4,,S,Regular,\nC5,1,S,Regular,2020-01-01,more\n")
    good = readers.read_csv(spark, f"{d}/t.csv", readers.GEN1_CUSTOMER_SCHEMA)
    assert [(r.customer_id, r.age) for r in good.orderBy("customer_id").collect()] == [("C1", 30), ("C4", None)]
    assert good.select("customer_id").count() == 2 and good.count() == 2           # whatever columns are asked for
    assert readers.set_aside(spark, f"{d}/t.csv", readers.GEN1_CUSTOMER_SCHEMA, f"{d}/bad") == 3
    assert sorted(r.line for r in spark.read.parquet(f"{d}/bad").collect()) == ["C2,old,N,Premium,2020-01-01", "C3,40", "C5,1,S,Regular,2020-01-01,more"]
    with pytest.raises(ValueError, match="3 lines"):
        readers.set_aside(spark, f"{d}/t.csv", readers.GEN1_CUSTOMER_SCHEMA, f"{d}/bad", allowed=2)


@pytest.mark.parametrize("broadcast_keys", [1_000_000, 0])
def test_keep_first_shuffles_rows_of_repeated_keys_only(spark, broadcast_keys):
    from basketry.operators import clean
    rows = [(f"k{i}", i, i) for i in range(3000)] + [("k7", -1, 70), (None, 2, 5), (None, 1, 6), ("hot", 0, 0)] + [("hot", i, i) for i in range(1, 1500)]
    df = spark.createDataFrame(rows, "k string, ingest_seq int, v int").repartition(6).checkpoint()
    out = clean.dedup_first(df, "k", ["ingest_seq"], broadcast_keys)
    first = {}
    for k, s, v in rows:
        first[k] = min(first.get(k, (s, v)), (s, v))
    assert sorted(((r.k, (r.ingest_seq, r.v)) for r in out.collect()), key=str) == sorted(first.items(), key=str)
    if broadcast_keys:
        assert max(n for _, n in exchanges(clean.dedup_first(df, "k", ["ingest_seq"]))) <= 3 * 6


def test_split_is_a_comparison_with_cut_keys(spark):
    from basketry.operators import churn
    df = spark.createDataFrame([(f"C{i}", i % 3 if i % 7 else None) for i in range(700)], "customer_id string, label int")
    out = churn.stratified_split(df)
    assert exchanges(out) == []
    got = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label in (0, 1, 2, None):
        n = got[label, "test"] + got[label, "train"]
        assert got[label, "test"] == -(-n // 5)
