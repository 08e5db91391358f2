"""BI measures behind the dashboard pages (survey X3-X12, J8, N5).

Revenue is carried as exact integer cents; figures are produced by one IEEE
division at the end (``mean_double``) or exact rounding (``round_ratio``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import exprs as X
from basketry.operators import selection
from basketry.operators.features import revenue
from basketry.operators.frames import combine_rows
from basketry.session import ensure_checkpoint_dir

# The channel columns of the category x channel matrix.
CHANNELS = ["Online", "In-Store", "Mobile App", "Phone"]


def _col_name(value: str) -> str:
    return value.lower().replace(" ", "_").replace("-", "_")


def bi_measures(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Churn %, return %, active customers, revenue, AOV, CLV (one row)."""
    c = customers.agg(
        F.count(F.lit(1)).alias("_nc"),
        F.count_if(F.col("is_churned") == 1).alias("_churned"),
        F.count_if(F.col("is_churned") == 0).alias("active_customers"))
    # one scan: the totals follow from the rows per customer, the NULL customer among them
    per_customer = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_returned") == 1).alias("returned"),
        F.sum(X.cents(revenue())).alias("rev"),
        F.sum(X.cents(F.col("final_amount"))).alias("fin"), F.count("final_amount").alias("nf"))
    known = F.col("customer_id").isNotNull()
    t = per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("_nt"), F.coalesce(F.sum("returned"), F.lit(0)).alias("_returned"),
        F.sum("rev").alias("_rev"), F.sum("fin").alias("_fin"), F.sum("nf").alias("_nf"),
        F.sum(F.when(known, F.col("rev"))).alias("_clv_rev"), F.count_if(known).alias("_buyers"))
    one = combine_rows(c, t)
    return one.select(
        X.mean_double(F.col("_churned") * 100, F.col("_nc")).alias("churn_rate_pct"),
        X.mean_double(F.col("_returned") * 100, F.col("_nt")).alias("return_rate_pct"),
        "active_customers",
        (F.col("_rev").cast("double") / 100.0).alias("total_revenue"),
        X.mean_double(F.col("_fin"), F.col("_nf") * 100).alias("avg_order_value"),
        X.mean_double(F.col("_clv_rev"), F.col("_buyers") * 100).alias("customer_lifetime_value"))


def _monthly_cents(transactions: DataFrame) -> DataFrame:
    t = transactions.where(F.col("transaction_date").isNotNull())
    return t.groupBy(F.trunc("transaction_date", "MM").alias("month")) \
        .agg(F.sum(X.cents(revenue())).alias("_rev"))


def _with_previous(monthly: DataFrame, own: list[str], total: str) -> DataFrame:
    """``monthly`` (a row a month) with ``_prev``, the ``total`` of the calendar month before.

    Each month sends its total to the month after; grouping brings both together, so the rows
    behind ``monthly`` are read once and a missing month gives NULL.
    """
    kinds = {c: monthly.schema[c].dataType for c in (*own, total)}
    here = F.struct(F.col("month").alias("month"), *[F.col(c).alias(c) for c in own], F.lit(None).cast(kinds[total]).alias("_prev"), F.lit(True).alias("_here"))
    after = F.struct(F.add_months("month", 1).alias("month"), *[F.lit(None).cast(kinds[c]).alias(c) for c in own],
                     F.col(total).alias("_prev"), F.lit(False).alias("_here"))
    sent = monthly.select(F.explode(F.array(here, after)).alias("s")).select("s.*")
    return sent.groupBy("month").agg(*[F.first(c, ignorenulls=True).alias(c) for c in own], F.max("_prev").alias("_prev"),
                                     F.max("_here").alias("_here")).where("_here").drop("_here")


def mom_growth(transactions: DataFrame) -> DataFrame:
    """X6 + J8 at month grain: against the previous calendar month, NULL where that is missing."""
    j = _with_previous(_monthly_cents(transactions), ["_rev"], "_rev")
    return j.select(
        "month",
        (F.col("_rev").cast("double") / 100.0).alias("revenue"),
        (F.col("_prev").cast("double") / 100.0).alias("prev_month_revenue"),
        F.when(F.col("_prev") != 0,
               X.mean_double((F.col("_rev") - F.col("_prev")) * 100, F.col("_prev")))
        .alias("mom_growth_pct")).orderBy("month")


def mtd_revenue(transactions: DataFrame) -> DataFrame:
    """N5 + X6 at day grain: month-to-date running total vs the full previous month."""
    t = transactions.where(F.col("transaction_date").isNotNull())
    daily = t.groupBy("transaction_date").agg(F.sum(X.cents(revenue())).alias("_day")) \
        .withColumn("month", F.trunc("transaction_date", "MM"))
    # A month holds at most 31 daily rows: the window partitions and the lists stay tiny.
    w = Window.partitionBy("month").orderBy("transaction_date") \
        .rowsBetween(Window.unboundedPreceding, 0)
    monthly = daily.withColumn("_mtd", F.sum("_day").over(w)).groupBy("month").agg(
        F.collect_list(F.struct("transaction_date", "_day", "_mtd")).alias("_days"), F.sum("_day").alias("_total"))
    j = _with_previous(monthly, ["_days"], "_total").select("month", "_prev", F.explode("_days").alias("d")).select("month", "_prev", "d.*")
    return j.select(
        "transaction_date", "month",
        (F.col("_day").cast("double") / 100.0).alias("daily_revenue"),
        (F.col("_mtd").cast("double") / 100.0).alias("mtd_revenue"),
        (F.col("_prev").cast("double") / 100.0).alias("prev_month_revenue"),
        F.when(F.col("_prev") != 0,
               X.mean_double((F.col("_mtd") - F.col("_prev")) * 100, F.col("_prev")))
        .alias("mom_growth_pct")).orderBy("transaction_date")


def revenue_by_segment_all(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Revenue per (segment, category) next to the segment total that ignores
    the category filter (ALLEXCEPT on segment).

    Transactions are reduced to (customer, category) before the join; the
    window runs over the per-(segment, category) rows only.
    """
    per = transactions.groupBy("customer_id", "product_category") \
        .agg(F.sum(X.cents(revenue())).alias("_rev"))
    g = customers.select("customer_id", "segment").join(per, "customer_id") \
        .groupBy("segment", "product_category").agg(F.sum("_rev").alias("_rev"))
    g = g.withColumn("_seg", F.sum("_rev").over(Window.partitionBy("segment")))
    return g.select("segment", "product_category",
                    (F.col("_rev").cast("double") / 100.0).alias("revenue"),
                    (F.col("_seg").cast("double") / 100.0).alias("segment_revenue"))


def category_channel_matrix(transactions: DataFrame) -> DataFrame:
    """Revenue matrix category x channel (pivot values listed, no extra pass)."""
    p = transactions.groupBy("product_category").pivot("channel", CHANNELS) \
        .agg(F.sum(X.cents(revenue())))
    return p.select("product_category", *[(F.col(ch).cast("double") / 100.0).alias(_col_name(ch))
                                          for ch in CHANNELS])


def churn_by_region(customers: DataFrame) -> DataFrame:
    """Churn rate by region (customer weighted)."""
    g = customers.groupBy("region").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("is_churned") == 1).alias("churned"),
        F.count("is_churned").alias("_n"))
    return g.select("region", "customers", "churned",
                    X.round_ratio(F.col("churned") * 100, F.col("_n"), 2).alias("churn_rate_pct"))


RISK_LEVELS = ["Low Risk", "Medium Risk", "High Risk"]


def churn_risk_by_segment(risk_flags: DataFrame, flag_col: str = "churn_risk_flag") -> DataFrame:
    """Churn-risk distribution per segment (stacked bar), pivot values listed."""
    p = risk_flags.groupBy("segment").pivot(flag_col, RISK_LEVELS).agg(F.count(F.lit(1)))
    return p.select("segment", *[F.coalesce(F.col(v), F.lit(0)).alias(_col_name(v))
                                 for v in RISK_LEVELS])


def high_risk_count(scores: DataFrame) -> DataFrame:
    """Customers whose churn prediction falls into the high-risk bin (one row)."""
    return scores.agg(F.count_if(F.col("churn_risk") == "High Risk").alias("high_risk_customers"))


def risk_list(scores: DataFrame) -> DataFrame:
    """The high-risk customers of a churn prediction, most probable first."""
    return scores.where(F.col("churn_risk") == "High Risk") \
        .orderBy(F.desc("churn_probability"), "customer_id")


def high_risk_customers(risk_flags: DataFrame) -> DataFrame:
    """The 'High Risk' rows of the churn-risk list."""
    return risk_flags.where(F.col("churn_risk_flag") == "High Risk")


def rfm_by_segment(scores: DataFrame) -> DataFrame:
    """Mean R, F, M per RFM segment (heatmap table)."""
    g = scores.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("R").alias("_r"), F.sum("F").alias("_f"), F.sum("M").alias("_m"))
    return g.select("rfm_segment", "customers",
                    X.mean_double(F.col("_r"), F.col("customers")).alias("avg_r"),
                    X.mean_double(F.col("_f"), F.col("customers")).alias("avg_f"),
                    X.mean_double(F.col("_m"), F.col("customers")).alias("avg_m"))


def histogram(df: DataFrame, metrics, bins: int = 40) -> DataFrame:
    """X11: equal-width histograms (numpy semantics: last bin right-inclusive, a constant
    column's range is widened by one half on each side, empty bins are rows) + median.

    Ends and medians are one row a metric; values of all metrics are then stacked into
    (metric, v) and counted by bin in one aggregation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    values = df.select(*[F.col(m).cast("double").alias(m) for m in metrics]).checkpoint(eager=True)
    medians = selection.quantiles(values, list(metrics), [0.5])
    ends = values.agg(*[f(m).alias(f"{f.__name__}_{m}") for m in metrics for f in (F.min, F.max)]).first()
    rows = []
    for m in metrics:
        if m in medians:
            low, high = ends[f"min_{m}"], ends[f"max_{m}"]
            half = 0.5 if low == high else 0.0
            rows.append((m, low - half, high + half, medians[m][0]))
    bounds = df.sparkSession.createDataFrame(rows, "metric string, _lo double, _hi double, median double")     # a row a metric
    stacked = values.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics]))
                            .alias("s")).select("s.*").where(F.col("v").isNotNull())
    j = stacked.join(F.broadcast(bounds), "metric")
    width = F.col("_hi") - F.col("_lo")
    step = width / bins
    raw = F.floor((F.col("v") - F.col("_lo")) * (F.lit(float(bins)) / width))
    idx0 = F.least(raw, F.lit(bins - 1))

    def edge(i):
        return F.when(i >= bins, F.col("_hi")).otherwise(F.col("_lo") + i * step)

    idx = (F.when(F.col("v") < edge(idx0), idx0 - 1)
           .when((F.col("v") >= edge(idx0 + 1)) & (idx0 != bins - 1), idx0 + 1)
           .otherwise(idx0)).cast("int")
    counted = j.withColumn("bin", idx).groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("customers"))
    every = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    b = F.col("bin")
    return every.join(counted, ["metric", "bin"], "left").select(
        "metric", "bin",
        edge(b).alias("bin_lower"), edge(b + 1).alias("bin_upper"),
        F.coalesce("customers", F.lit(0)).alias("customers"), "median")
