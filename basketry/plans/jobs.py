"""Composed jobs (survey E1-E9): the reference's pipeline steps on one session.

Stages hand DataFrames to each other instead of re-reading CSV files; the
cleaned transactions, reused by every later stage, are cut from their
lineage with a reliable checkpoint (``spark.checkpoint.dir``), so a lost
executor does not re-run the cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import bi, churn, clean, features, quality, reports, segment
from basketry.session import ensure_checkpoint_dir
from basketry.sources import writers as W


def _stable(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_etl(raw_customers: DataFrame, raw_transactions: DataFrame, out_dir: str | None = None, *,
            snapshot, tenure_date, fmt: str = "parquet", fail_on_issues: bool = False) -> dict:
    """Clean -> RFM -> validate -> load.  A failed validation is reported and,
    as in the reference, does not stop the load unless ``fail_on_issues``.

    ``snapshot`` (recency) and ``tenure_date`` belong to the data, so they have no default.
    """
    customers = _stable(clean.clean_customers(raw_customers, tenure_date))
    transactions = _stable(clean.clean_transactions(raw_transactions))
    counts = {"customers": clean.row_counts(raw_customers, customers),
              "transactions": clean.row_counts(raw_transactions, transactions)}
    rfm = _stable(features.rfm_quantile_scores(features.rfm_base(transactions, snapshot)))
    report = quality.quality_report(customers, transactions, materialize=False)  # already cut
    passed = bool(report.where(F.col("check") == "all_checks").first()["passed"])
    if fail_on_issues and not passed:
        raise ValueError("data quality checks failed")
    monthly = features.monthly_summary(transactions)
    c360 = features.customer_360(customers, rfm)
    out = {"customers": customers, "transactions": transactions, "rfm": rfm, "row_counts": counts,
           "quality": report, "passed": passed, "monthly_summary": monthly, "customer_360": c360}
    if out_dir:
        out["paths"] = W.load_data(customers, transactions, rfm, out_dir, fmt,
                                   monthly=monthly, customer_360=c360)
    return out


def run_gen1_etl(raw_customers: DataFrame, raw_transactions: DataFrame,
                 out_dir: str | None = None) -> dict:
    """Gen-1 clean -> enrich (left join customers, revenue, month, year) -> RFM."""
    c, t = clean.clean_gen1(raw_customers, raw_transactions)
    processed = t.join(c, "customer_id", "left") \
        .withColumn("revenue", F.col("amount") * F.col("quantity")) \
        .withColumn("month", F.date_format("date", "yyyy-MM")).withColumn("year", F.year("date"))
    rfm = features.rfm_gen1(t)
    profile = quality.profile(processed, "date")
    out = {"processed": processed, "rfm": rfm, "profile": profile}
    if out_dir:
        out["paths"] = W.write_gen1(processed, rfm, out_dir)
    return out


def sql_report_pack(customers: DataFrame, transactions: DataFrame) -> dict[str, DataFrame]:
    """The eight named reports of the SQL runner."""
    return {
        "kpi_summary": reports.kpi_summary(customers, transactions),
        "monthly_revenue": reports.monthly_revenue(transactions),
        "category_performance": reports.category_performance(transactions),
        "segment_analysis": reports.segment_analysis(customers, transactions),
        "regional_performance": reports.regional_performance(customers, transactions),
        "channel_performance": reports.channel_performance(transactions),
        "top20_customers": reports.top_customers_ltv(customers, transactions, 20),
        "payment_method_analysis": reports.payment_methods(transactions),
    }


def run_sql_pack(customers: DataFrame, transactions: DataFrame, out_dir: str,
                 fmt: str = "parquet") -> dict[str, str]:
    return W.write_reports(sql_report_pack(customers, transactions), out_dir, fmt=fmt)


def register_sql_views(customers: DataFrame, transactions: DataFrame) -> list[str]:
    """S5 + the SQL file's view: ``customers``, ``transactions`` and
    ``vw_customer_360`` become queryable with ``spark.sql``."""
    views = {"customers": customers, "transactions": transactions,
             "vw_customer_360": features.customer_360_view(customers, transactions)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def run_segmentation(customer_360: DataFrame, out_dir: str | None = None, **kw) -> dict:
    """E4 (+ W6, W8)."""
    res = segment.run_segmentation(customer_360, **kw)
    if out_dir:
        W.write_table(res["segments"], out_dir, "customer_segments")
        W.write_table(res["summary"], out_dir, "cluster_summary", single_file=True)
        W.save_model(res["model"], f"{out_dir}/kmeans_model")
        W.save_model(res["scaler"], f"{out_dir}/scaler")
    return res


def run_churn(customer_360: DataFrame, out_dir: str | None = None, **kw) -> dict:
    """E5 (+ W7, W8)."""
    res = churn.run_churn_model(customer_360, **kw)
    if out_dir:
        W.write_table(res["scores"], out_dir, "churn_predictions")
        W.save_model(res["models"][res["best"]], f"{out_dir}/churn_model_best")
    return res


def run_dashboard(customers: DataFrame, transactions: DataFrame, rfm: DataFrame,
                  out_dir: str | None = None) -> dict[str, DataFrame]:
    """KPI table and the data behind every dashboard chart, plus BI exports."""
    out = {
        "kpi_summary": reports.kpi_customer_weighted(customers, transactions),
        "revenue_trend": reports.monthly_excel(transactions),
        "category_performance": reports.category_chart(transactions),
        "channel_analysis": reports.channel_share(transactions),
        "rfm_distributions": bi.histogram(rfm, ["recency", "frequency", "monetary"]),
        "customer_segments": reports.segment_customers(customers),
        "powerbi_daily_revenue": reports.daily_revenue(transactions),
        "powerbi_customer_profile": features.customer_360(customers, rfm),
    }
    if out_dir:
        W.write_kpis(out["kpi_summary"], out_dir)
        W.export_powerbi(out["powerbi_daily_revenue"], out["powerbi_customer_profile"], out_dir)
    return out


def excel_tables(customers: DataFrame, transactions: DataFrame) -> dict[str, DataFrame]:
    """The four workbook tables (KPI cards, monthly revenue, segments, categories)."""
    return {
        "kpi": reports.excel_kpis(customers, transactions),
        "revenue": reports.monthly_excel(transactions),
        "segments": reports.segment_customers(customers),
        "categories": reports.excel_category(transactions),
    }


def run_all(spark: SparkSession, raw_customers: DataFrame, raw_transactions: DataFrame,
            out_dir: str, *, snapshot, tenure_date, **model_kw) -> dict:
    """ETL -> segmentation -> churn -> dashboard on one session."""
    etl = run_etl(raw_customers, raw_transactions, f"{out_dir}/processed",
                  snapshot=snapshot, tenure_date=tenure_date)
    seg = run_segmentation(etl["customer_360"], f"{out_dir}/segments", **model_kw)
    ch = run_churn(etl["customer_360"], f"{out_dir}/churn")
    dash = run_dashboard(etl["customers"], etl["transactions"], etl["rfm"], f"{out_dir}/exports")
    return {"etl": etl, "segmentation": seg, "churn": ch, "dashboard": dash}


def run_gen1_models(rfm: DataFrame, out_dir: str | None = None) -> dict:
    """Gen-1 segmentation (k = 4) and churn forest on the 3 RFM features."""
    seg = segment.segment_gen1(rfm)
    ch = churn.churn_gen1(rfm)
    if out_dir:
        W.write_table(seg, out_dir, "segmented_customers")
        W.write_table(ch["scores"], out_dir, "churn_scores")
    return {"segments": seg, **ch}
