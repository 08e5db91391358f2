"""End-to-end jobs: CSV read (S1) -> ETL (E1) -> load (W1) -> read back (S3);
models and the streaming refresh."""

import tempfile

import pytest
from pyspark.sql import functions as F

from basketry.operators import churn, clean, reports, segment
from basketry.plans import jobs
from basketry.sources import readers, writers
from basketry.streaming import refresh


SF_SMALL_DIR = "/root/testdata/sf0.001"


def _scratch():
    return tempfile.mkdtemp(prefix="basketry-test-")


def test_etl_from_csv(spark, inputs):
    d = _scratch()
    writers.write_table(inputs.raw_customers.drop("ingest_seq"), d, "raw_customers", "csv",
                        single_file=True)
    writers.write_table(inputs.raw_transactions.drop("ingest_seq"), d, "raw_transactions", "csv",
                        single_file=True)
    c, t = readers.extract_data(spark, f"{d}/raw_customers", f"{d}/raw_transactions")
    out = jobs.run_etl(c, t, f"{d}/processed", snapshot="2001-08-02", tenure_date="2001-08-01")
    assert out["passed"] is False                      # orphans in the dirty fixture
    counts = out["row_counts"]["transactions"]         # C9 accounting
    assert counts["before"] - counts["removed"] == counts["after"] == out["transactions"].count()
    assert counts["removed"] > 0
    back = readers.load_processed(spark, f"{d}/processed")
    assert back["transactions_cleaned"].count() == out["transactions"].count()
    assert back["customers_cleaned"].count() == inputs.dirty_customers_clean.count()
    assert set(back["transactions_cleaned"].columns) >= {"year", "month", "revenue"}


def test_streaming_refresh_equals_batch(spark, inputs):
    d = _scratch()
    t = inputs.transactions
    t.where(F.col("transaction_date") < "1998-01-01").write.parquet(f"{d}/src/part1")
    q = refresh.start_daily_refresh(spark, f"{d}/src/*", f"{d}/out", f"{d}/ckpt")
    q.awaitTermination()
    t.where(F.col("transaction_date") >= "1998-01-01").write.parquet(f"{d}/src/part2")
    q = refresh.start_daily_refresh(spark, f"{d}/src/*", f"{d}/out", f"{d}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{d}/out")
    want = reports.daily_revenue(clean.add_transaction_features(t))
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_segmentation_and_churn(spark, inputs):
    res = segment.run_segmentation(inputs.customer_360, ks=range(2, 4), n_init=2, max_iter=50)
    seg = res["segments"]
    assert res["summary"].agg(F.sum("customer_count")).first()[0] == seg.count()
    assert seg.where(F.col("segment_label").isNull()).count() == 0
    d = _scratch()
    writers.save_model(res["scaler"], f"{d}/scaler")
    again = writers.load_pipeline(f"{d}/scaler").transform(res["scaled"].drop("features"))
    assert again.count() == res["scaled"].count()

    ch = churn.run_churn_model(inputs.customer_360)
    metrics = {r.model: r for r in ch["metrics"].collect()}
    assert set(metrics) == {"Logistic Regression", "Random Forest", "Gradient Boosting"}
    assert all(0 <= r.auc <= 1 for r in metrics.values())
    scores = ch["scores"]
    assert scores.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0
    assert scores.count() == ch["split"].count()
    imp = ch["importance"].agg(F.sum("importance")).first()[0]
    assert imp == pytest.approx(1.0, abs=1e-6)
    n_test = ch["split"].where(F.col("split") == "test").count()
    for name, cm in ch["confusion"].items():
        assert cm.agg(F.sum(F.col("predicted_0") + F.col("predicted_1"))).first()[0] == n_test
        last = ch["roc"][name].agg(F.max("tpr"), F.max("fpr")).first()
        assert last[0] == pytest.approx(1.0) and last[1] == pytest.approx(1.0)


def test_gen1_pipeline(spark, inputs):
    from basketry.sources import tables as T
    d = _scratch()
    out = jobs.run_gen1_etl(T.raw_gen1_customers(spark, SF_SMALL_DIR),
                            T.raw_gen1_transactions(spark, SF_SMALL_DIR), f"{d}/gen1")
    prof = out["profile"].first()
    assert prof.total_rows == out["processed"].count() and prof.null_amount == 0
    assert set(out["processed"].columns) >= {"revenue", "month", "year", "segment"}
    models = jobs.run_gen1_models(out["rfm"], f"{d}/gen1_models")
    labels = {r[0] for r in models["segments"].select("segment_label").distinct().collect()}
    assert labels <= {"Champions", "At Risk", "Regular"} and "At Risk" in labels
    assert {r["class"] for r in models["report"].collect()} >= {"0", "1", "accuracy"}
    assert spark.read.parquet(f"{d}/gen1_models/churn_scores").count() == out["rfm"].count()


def test_report_pack_dashboard_and_exports(spark, inputs):
    d = _scratch()
    c, t = inputs.customers, inputs.transactions_featured
    paths = jobs.run_sql_pack(c, t, f"{d}/sql")
    assert len(paths) == 8
    assert spark.read.parquet(paths["top20_customers"]).count() == 20
    rfm = inputs.rfm_scores
    dash = jobs.run_dashboard(c, t, rfm, f"{d}/exports")
    kpi = spark.read.option("header", True).csv(f"{d}/exports/kpi_summary")
    assert kpi.count() == 10 and set(kpi.columns) == {"KPI", "Value"}
    daily = spark.read.option("header", True).csv(f"{d}/exports/powerbi_daily_revenue")
    assert daily.count() == dash["powerbi_daily_revenue"].count()
    assert set(jobs.excel_tables(c, t)) == {"kpi", "revenue", "segments", "categories"}
    exp = writers.plain_exports(c, inputs.transactions, rfm, f"{d}/excel")
    sample = spark.read.option("header", True).csv(exp["excel_transactions_sample"])
    assert sample.count() == min(10000, inputs.transactions.count())
    views = jobs.register_sql_views(c, inputs.transactions)
    assert spark.sql("SELECT COUNT(*) FROM vw_customer_360").first()[0] == c.count()
    assert "vw_customer_360" in views
