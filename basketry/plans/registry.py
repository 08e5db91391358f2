"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

``basketry.sources.tables`` and runs over whole tables.  Decimal outputs are
cast to DOUBLE at the very end (``finalize``) so both engines present money
the same way; all arithmetic before that is exact.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from basketry.functions import exprs as X
from basketry.operators import bi, churn, clean, evaluate, features, quality, reports, segment
from basketry.sources import tables as T
from basketry.sources import writers as W

# Parameters on the driver data (FIXTURES.md §3): these dates play the
# reference's 2025-01-01 snapshot and 2024-12-31 tenure date.
SNAPSHOT = "2001-08-02"
TENURE_DATE = "2001-08-01"


def finalize(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


class Sources:
    """The loaded input tables of one data folder, shared by all queries of a session.

    By default each query scans the parquet tables itself, so column pruning
    and filter pushdown reach the scan.  ``BASKETRY_CACHE_SOURCES=1`` persists
    the mapped tables instead (MEMORY_AND_DISK), for many reports in one
    session on data that fits.  Operator work on top is never cached.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _load(self, df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK) if CACHE_SOURCES else df

    @cached_property
    def customers(self) -> DataFrame:
        return self._load(T.customers(self.spark, self.sf_dir))

    @cached_property
    def transactions(self) -> DataFrame:
        return self._load(T.transactions(self.spark, self.sf_dir))

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._load(T.raw_customers(self.spark, self.sf_dir))

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return self._load(T.raw_transactions(self.spark, self.sf_dir))


CACHE_SOURCES = os.environ.get("BASKETRY_CACHE_SOURCES", "0") == "1"
_SOURCES: dict = {}


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = Sources(spark, sf_dir)
    return _SOURCES[key]


class Inputs:
    """Input frames of one query call; derived frames are rebuilt per call."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.src = sources(spark, sf_dir)

    @property
    def customers(self) -> DataFrame:
        return self.src.customers

    @property
    def transactions(self) -> DataFrame:
        return self.src.transactions

    @cached_property
    def transactions_featured(self) -> DataFrame:
        """Mapped transactions with the C7 feature columns (they are already clean)."""
        return clean.add_transaction_features(self.transactions)

    @cached_property
    def gen1_customers(self) -> DataFrame:
        return self.customers.select(*T.GEN1_CUSTOMER_COLUMNS)

    @cached_property
    def gen1_transactions(self) -> DataFrame:
        t = self.transactions
        for old, new in T.GEN1_TRANSACTION_RENAMES.items():
            t = t.withColumnRenamed(old, new)
        return t.select(*T.GEN1_TRANSACTION_COLUMNS)

    @property
    def raw_customers(self) -> DataFrame:
        return self.src.raw_customers

    @property
    def raw_transactions(self) -> DataFrame:
        return self.src.raw_transactions

    @cached_property
    def rfm_base(self) -> DataFrame:
        return features.rfm_base(self.transactions, SNAPSHOT)

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return features.rfm_quantile_scores(self.rfm_base)

    @cached_property
    def customers_clean(self) -> DataFrame:
        return clean.clean_customers(self.customers, tenure_date=TENURE_DATE)

    @cached_property
    def dirty_customers_clean(self) -> DataFrame:
        return clean.clean_customers(self.raw_customers, tenure_date=TENURE_DATE)

    @cached_property
    def dirty_transactions_clean(self) -> DataFrame:
        return clean.clean_transactions(self.raw_transactions)

    @cached_property
    def activity(self) -> DataFrame:
        return features.customer_activity(self.customers, self.transactions, SNAPSHOT)

    @cached_property
    def idle_scores(self) -> DataFrame:
        return evaluate.idle_days_scorer(self.activity)

    @cached_property
    def customer_360(self) -> DataFrame:
        return features.customer_360(self.customers_clean, self.rfm_scores)

    def memo(self, key: str, build):
        """Fitted models are reused across the queries of one session and folder."""
        slot = (self.spark.sparkContext.applicationId, self.sf_dir, key)
        if slot not in _MODEL_MEMO:
            _MODEL_MEMO[slot] = build()
        return _MODEL_MEMO[slot]

    @property
    def segmentation(self) -> dict:
        return self.memo("segmentation", lambda: segment.run_segmentation(self.customer_360))

    @property
    def churn_run(self) -> dict:
        return self.memo("churn", lambda: churn.run_churn_model(self.customer_360))

    @cached_property
    def idle_risk(self) -> DataFrame:
        """Churn score table (M22) of a fixed probability, d / (d + 180) of the days idle."""
        d = F.col("days_since_last_purchase").cast("double")
        scored = self.activity.where(d.isNotNull()).withColumn("score", d / (d + 180.0))
        return churn.risk_scores(scored)

    @cached_property
    def fixed_clusters(self) -> DataFrame:
        """RFM points under a fixed assignment: the customer number modulo 4."""
        number = F.substring("customer_id", 5, 20).cast("long")
        return self.gen1_rfm.join(self.customers.select("customer_id", "loyalty_points"), "customer_id") \
            .withColumn("cluster", (number % 4).cast("int"))

    @property
    def gen1_rfm(self) -> DataFrame:
        return features.rfm_gen1(self.gen1_transactions)


_MODEL_MEMO: dict = {}


def forget_models() -> None:
    """Fit anew at the next call (benchmarks)."""
    _MODEL_MEMO.clear()


def _q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(Inputs(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # SQL report pack (E3) and the analytical SQL file
    "kpi_summary": lambda d: reports.kpi_summary(d.customers, d.transactions),
    "monthly_revenue": lambda d: reports.monthly_revenue(d.transactions),
    "category_performance": lambda d: reports.category_performance(d.transactions),
    "segment_analysis": lambda d: reports.segment_analysis(d.customers, d.transactions),
    "channel_performance": lambda d: reports.channel_performance(d.transactions),
    "regional_performance": lambda d: reports.regional_performance(d.customers, d.transactions),
    "payment_methods": lambda d: reports.payment_methods(d.transactions),
    "weekend_weekday": lambda d: reports.weekend_weekday(d.transactions),
    "top20_customers": lambda d: reports.top_customers_ltv(d.customers, d.transactions, 20),
    "churn_risk_flag": lambda d: reports.churn_risk_flags(d.customers, d.transactions, SNAPSHOT),
    "cohort_first_purchase": lambda d: reports.cohort_first_purchase(d.transactions),
    "customer_360_view": lambda d: features.customer_360_view(d.customers, d.transactions),
    "customer_activity": lambda d: features.customer_activity(d.customers, d.transactions, SNAPSHOT),
    # gen-1 SQL (MySQL dialect)
    "monthly_revenue_net": lambda d: reports.monthly_revenue_net(d.gen1_transactions),
    "top10_customers": lambda d: reports.top_customers_revenue(d.gen1_customers,
                                                               d.gen1_transactions, 10),
    "category_returns": lambda d: reports.category_returns(d.gen1_transactions),
    "cohort_join_month": lambda d: reports.cohort_join_month(d.gen1_customers, d.gen1_transactions),
    "churn_risk_having": lambda d: reports.churn_risk_having(d.gen1_transactions, SNAPSHOT),
    "segment_return_rate": lambda d: reports.segment_return_rate(d.gen1_customers,
                                                                 d.gen1_transactions),
    # pandas-derived tables
    "monthly_excel": lambda d: reports.monthly_excel(d.transactions_featured),
    "category_chart": lambda d: reports.category_chart(d.transactions_featured),
    "channel_share": lambda d: reports.channel_share(d.transactions_featured),
    "segment_customers": lambda d: reports.segment_customers(d.customers),
    "daily_revenue": lambda d: reports.daily_revenue(d.transactions_featured),
    "monthly_summary": lambda d: features.monthly_summary(d.transactions_featured),
    "kpi_customer_weighted": lambda d: reports.kpi_customer_weighted(d.customers,
                                                                     d.transactions_featured),
    # RFM
    "rfm_ntile": lambda d: features.rfm_ntile_scores(features.rfm_sql_base(d.transactions, SNAPSHOT)),
    "rfm_quantile": lambda d: d.rfm_scores,
    "rfm_gen1": lambda d: features.rfm_gen1(d.gen1_transactions),
    "rfm_segment_counts": lambda d: features.rfm_segment_counts(d.rfm_scores),
    "rfm_by_segment": lambda d: bi.rfm_by_segment(d.rfm_scores),
    "customer_360_rfm": lambda d: features.customer_360(d.customers_clean, d.rfm_scores),
    # cleaning and validation on the dirty fixture
    "clean_customers": lambda d: d.dirty_customers_clean,
    "clean_transactions": lambda d: d.dirty_transactions_clean,
    "clean_gen1": lambda d: clean.clean_gen1(T.raw_gen1_customers(d.spark, d.sf_dir),
                                             T.raw_gen1_transactions(d.spark, d.sf_dir))[1],
    "quality_report": lambda d: quality.quality_report(
        d.dirty_customers_clean,
        clean.clean_transactions(d.raw_transactions, columns=quality.TRANSACTION_RULE_COLUMNS)),
    "orphans": lambda d: quality.orphan_transactions(
        clean.clean_transactions(d.raw_transactions, columns=["transaction_id", "customer_id"]),
        d.raw_customers, keys_from=d.raw_transactions)
    .select("transaction_id", "customer_id"),
    # BI measures
    "bi_measures": lambda d: bi.bi_measures(d.customers, d.transactions),
    "mom_growth": lambda d: bi.mom_growth(d.transactions),
    "mtd_revenue": lambda d: bi.mtd_revenue(d.transactions),
    "revenue_by_segment_all": lambda d: bi.revenue_by_segment_all(d.customers, d.transactions),
    "category_channel_matrix": lambda d: bi.category_channel_matrix(d.transactions),
    "churn_by_region": lambda d: bi.churn_by_region(d.customers),
    "high_risk_customers": lambda d: bi.high_risk_customers(
        reports.churn_risk_flags(d.customers, d.transactions, SNAPSHOT)),
    "churn_risk_by_segment": lambda d: bi.churn_risk_by_segment(
        reports.churn_risk_flags(d.customers, d.transactions, SNAPSHOT)),
    "rfm_histogram": lambda d: bi.histogram(d.rfm_base, ["recency", "frequency", "monetary"]),
    # slicers, gen-1 enrichment, sample export
    "sliced_revenue": lambda d: sliced_revenue(d),
    "enriched_gen1": lambda d: enriched_gen1(d),
    "first_n_sample": lambda d: W.first_n(d.transactions, 10000),
    # evaluation with a deterministic score
    "stratified_split": lambda d: churn.stratified_split(
        d.customers.select("customer_id", "is_churned"), label="is_churned"),
    "eval_auc": lambda d: evaluate.roc_auc(d.idle_scores),
    "eval_average_precision": lambda d: evaluate.average_precision(d.idle_scores),
    "eval_roc": lambda d: evaluate.roc_points(d.idle_scores),
    "eval_report": lambda d: evaluate.classification_report(d.idle_scores),
    "eval_confusion": lambda d: evaluate.confusion_matrix(d.idle_scores),
    # workbook tables, risk prediction and model-job parts, on fixed scores and assignments
    "excel_category": lambda d: reports.excel_category(d.transactions_featured),
    "excel_kpis": lambda d: reports.excel_kpis(d.customers, d.transactions),
    "null_profile": lambda d: quality.profile(
        T.raw_gen1_transactions(d.spark, d.sf_dir).drop("ingest_seq"), "date"),
    "churn_risk_scores": lambda d: d.idle_risk,
    "risk_list": lambda d: bi.risk_list(d.idle_risk),
    "high_risk_count": lambda d: bi.high_risk_count(d.idle_risk),
    "sliced_by_risk": lambda d: reports.category_channel(clean.apply_slicers(
        d.transactions, risks=["High Risk"], risk_scores=d.idle_risk)),
    "cluster_names_fixed": lambda d: segment.label_clusters(d.fixed_clusters)
    .select("customer_id", "cluster", "segment_label"),
    "cluster_names_gen1_fixed": lambda d: segment.label_clusters_gen1(d.fixed_clusters)
    .select("customer_id", "cluster", "segment_label"),
    "cluster_summary_fixed": lambda d: segment.cluster_summary(segment.label_clusters(d.fixed_clusters)),
    "cluster_profile_fixed": lambda d: rounded(
        segment.cluster_profile(d.fixed_clusters, segment.GEN1_FEATURES), 6),
    "gen1_churn_label": lambda d: d.gen1_rfm.select(
        "customer_id", "recency", X.recency_churn_label("recency").alias("label")),
    "standardised_features": lambda d: standardised(d.gen1_rfm),
    "label_encoding": lambda d: churn.engineer_features(d.customer_360).select(
        "customer_id", "gender_enc", "region_enc", "segment_enc", "label"),
    # MLlib jobs (no SQL oracle: rows-only check)
    "kmeans_k_sweep": lambda d: d.segmentation["sweep"],
    "kmeans_segments": lambda d: d.segmentation["segments"],
    "cluster_summary": lambda d: d.segmentation["summary"],
    "cluster_profile": lambda d: d.segmentation["profile"],
    "pca_projection": lambda d: segment.pca_projection(d.segmentation["assigned"])[0],
    "churn_model_metrics": lambda d: d.churn_run["metrics"],
    "churn_scores": lambda d: d.churn_run["scores"],
    "feature_importance": lambda d: d.churn_run["importance"],
    "segment_gen1": lambda d: d.memo("seg1", lambda: segment.segment_gen1(d.gen1_rfm)),
    "churn_gen1_scores": lambda d: d.memo("churn1", lambda: churn.churn_gen1(d.gen1_rfm))["scores"],
}

# Slicer settings of the registered C12 query.
SLICE = dict(date_from="1996-01-01", date_to="1998-12-31", regions=["AMERICA", "ASIA", "EUROPE"],
             segments=["Premium", "Regular"], channels=["Online", "Mobile App"])


def sliced_revenue(d: Inputs) -> DataFrame:
    """Revenue by category and channel under the dashboard slicers."""
    return reports.category_channel(clean.apply_slicers(d.transactions, d.customers, **SLICE))


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Means of doubles, rounded so that the order of a distributed sum does not show."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def standardised(rfm: DataFrame) -> DataFrame:
    """M1: the standardised RFM features as columns."""
    scaled, _ = segment.prepare_features(rfm, segment.GEN1_FEATURES)
    z = vector_to_array("features")
    return scaled.select("customer_id", *[F.round(z[i], 6).alias(f"z_{c}") for i, c in enumerate(segment.GEN1_FEATURES)])


def enriched_gen1(d: Inputs) -> DataFrame:
    """E2 transform: C8 cleaning, transactions LEFT JOIN customers, revenue, month, year."""
    c, t = clean.clean_gen1(d.gen1_customers, d.gen1_transactions)
    j = t.join(c, "customer_id", "left")
    return j.withColumn("revenue", F.col("amount") * F.col("quantity")) \
        .withColumn("month", F.date_format("date", "yyyy-MM")) \
        .withColumn("year", F.year("date"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in QUERIES.items()}
