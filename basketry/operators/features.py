"""Customer feature tables (survey A1-A10) and the shared per-customer pre-aggregate.

Averages over ``customers LEFT JOIN transactions`` are transaction weighted
(a customer with k transactions counts k times, one without counts once).
Instead of materialising that fan-out join, transactions are first reduced to
one row per customer (partial aggregation happens map side, so even a
customer holding a third of all rows becomes one row per map task), joined
1:1 to customers, and rolled up with weights ``coalesce(n_rows, 1)``.
Sums and counts are then identical to the fan-out form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import exprs as X
from basketry.operators import ranking, selection
from basketry.session import ensure_checkpoint_dir


def revenue(price_col: str = "final_amount") -> F.Column:
    return F.col(price_col) * F.col("quantity")


def customer_txn_stats(transactions: DataFrame, price_col: str = "final_amount",
                       date_col: str = "transaction_date") -> DataFrame:
    """One row per customer_id with the additive pieces every report needs."""
    t = transactions
    cols = set(t.columns)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("transaction_id").alias("n_txn"),
        F.sum(X.cents(revenue(price_col))).alias("rev_cents"),
        F.sum(X.cents(F.col(price_col))).alias("price_cents"),
        F.count(price_col).alias("n_price"),
        F.max(date_col).alias("last_date"),
        F.min(date_col).alias("first_date"),
    ]
    if "rating" in cols:
        aggs += [F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_rating")]
    if "discount_percent" in cols:
        aggs += [F.sum(X.cents(F.col("discount_percent"))).alias("disc_cents"),
                 F.count("discount_percent").alias("n_disc")]
    returned = "is_returned" if "is_returned" in cols else ("returned" if "returned" in cols else None)
    if returned:
        aggs += [F.sum(returned).alias("ret_sum"), F.count(returned).alias("n_ret")]
    return t.groupBy("customer_id").agg(*aggs)


# ---------------------------------------------------------------------------
# RFM (A1-A6)
# ---------------------------------------------------------------------------
def rfm_base(transactions: DataFrame, snapshot, exclude_returns: bool = True,
             price_col: str = "final_amount", date_col: str = "transaction_date",
             returned_col: str = "is_returned") -> DataFrame:
    """recency (days from the last purchase to ``snapshot``), frequency, monetary.

    pandas semantics: NULL customer keys are dropped (T1) and the sum of an
    all-NULL group is 0 (T2).
    """
    t = transactions.where(F.col("customer_id").isNotNull())
    if exclude_returns:
        t = t.where(F.col(returned_col) == 0)
    return t.groupBy("customer_id").agg(
        X.date_days_between(X.as_date(snapshot), F.max(date_col)).alias("recency"),
        F.count("transaction_id").alias("frequency"),
        F.coalesce(F.sum(revenue(price_col)), F.lit(0)).alias("monetary"))


def rfm_gen1(transactions: DataFrame) -> DataFrame:
    """Gen 1: all rows, snapshot = the latest date in the data (one-row aggregate)."""
    snapshot = transactions.agg(F.max("date").alias("d")).first()["d"]
    return rfm_base(transactions, snapshot, exclude_returns=False, price_col="amount",
                    date_col="date")


def rfm_quantile_scores(rfm: DataFrame, q: int = 5) -> DataFrame:
    """A4: R/M by quantile bins (R reversed), F by quintiles of the first-rank.

    The R/M bin edges are exact order statistics.  F is pandas
    ``qcut(rank(method="first"))``, whose edges sit at 1 + i (n - 1) / q: its cuts are the
    (frequency, customer_id) keys at the ranks just before those, selected exactly, so no
    customer is ranked and nothing is joined.
    """
    ensure_checkpoint_dir(rfm.sparkSession)
    rfm = rfm.checkpoint(eager=True)       # edges, cuts and scores read the very same rows
    edges = ranking.qcut_edges_many(rfm, ["recency", "monetary"], q)
    by_frequency = selection.Dimension(F.col("frequency"))
    cuts, = selection.cut_keys(rfm, "customer_id", [by_frequency], lambda n: sorted({i * (n - 1) // q + 1 for i in range(1, q)} if n else set()))
    scored = rfm.withColumn("R", ranking.qcut_expr("recency", edges["recency"], descending=True)) \
        .withColumn("M", ranking.qcut_expr("monetary", edges["monetary"])) \
        .withColumn("F", selection.buckets_from_cuts(rfm, "customer_id", by_frequency, cuts).cast("int"))
    total = F.col("R") + F.col("F") + F.col("M")
    return scored.select(*rfm.columns, "R", "F", "M") \
        .withColumn("rfm_score", total.cast("int")) \
        .withColumn("rfm_segment", X.rfm_segment(total))


def rfm_sql_base(transactions: DataFrame, snapshot) -> DataFrame:
    """A3: the SQL form: non-returned, monetary rounded to 2 decimals."""
    t = transactions.where(F.col("is_returned") == 0)
    return t.groupBy("customer_id").agg(
        X.date_days_between(X.as_date(snapshot), F.max("transaction_date")).alias("recency_days"),
        F.count("transaction_id").alias("frequency"),
        F.round(F.sum(revenue()), 2).alias("monetary"))


def rfm_ntile_scores(base: DataFrame, buckets: int = 5) -> DataFrame:
    """A5: NTILE(5) per dimension with customer_id as the last order key."""
    s = ranking.global_ntiles(base, "customer_id", [("r_score", "recency_days", True),
                                                    ("f_score", "frequency", False),
                                                    ("m_score", "monetary", False)], buckets)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return s.withColumn("rfm_total", total.cast("int")).withColumn("rfm_segment", X.rfm_segment(total)) \
        .orderBy(F.desc("rfm_total"), "customer_id")


def rfm_segment_counts(scores: DataFrame, segment_col: str = "rfm_segment") -> DataFrame:
    return scores.groupBy(segment_col).agg(F.count(F.lit(1)).alias("customers")) \
        .orderBy(F.desc("customers"), segment_col)


# ---------------------------------------------------------------------------
# Customer-level tables
# ---------------------------------------------------------------------------
def customer_activity(customers: DataFrame, transactions: DataFrame, snapshot) -> DataFrame:
    stats = customer_txn_stats(transactions)
    j = customers.join(stats, "customer_id", "left")
    return j.select(
        "customer_id", "segment", "region", "loyalty_points", "is_churned",
        F.coalesce(F.col("n_txn"), F.lit(0)).alias("total_transactions"),
        F.col("last_date").alias("last_purchase_date"),
        X.date_days_between(X.as_date(snapshot), F.col("last_date")).alias("days_since_last_purchase"),
        X.round_ratio(F.col("rating_sum"), F.col("n_rating"), 2).alias("avg_rating"))


def customer_360_view(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """The SQL view (per-customer aggregate, left joined)."""
    stats = customer_txn_stats(transactions)
    j = customers.join(stats, "customer_id", "left")
    return j.select(
        "customer_id", "age", "gender", "region", "segment", "loyalty_points", "join_date",
        "is_churned",
        F.coalesce(F.col("n_txn"), F.lit(0)).alias("total_orders"),
        X.round_ratio(F.col("rev_cents"), F.lit(100), 2).alias("lifetime_value"),
        X.round_ratio(F.col("price_cents"), F.col("n_price") * 100, 2).alias("avg_order_value"),
        F.col("last_date").alias("last_purchase_date"),
        X.round_ratio(F.col("rating_sum"), F.col("n_rating"), 2).alias("avg_rating"),
        X.round_ratio(F.col("disc_cents"), F.col("n_disc") * 100, 2).alias("avg_discount_used"))


def customer_360(customers_clean: DataFrame, rfm_scores: DataFrame) -> DataFrame:
    """Cleaned customers left joined with their RFM row."""
    return customers_clean.join(rfm_scores, "customer_id", "left")


def monthly_summary(transactions_clean: DataFrame) -> DataFrame:
    """A10: year, month, month_name, category -> revenue, count, AOV, return rate."""
    t = transactions_clean.where(
        F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("month_name").isNotNull()
        & F.col("product_category").isNotNull())
    g = t.groupBy("year", "month", "month_name", "product_category").agg(
        F.sum(X.cents(F.col("revenue"))).alias("_rev"),
        F.count("transaction_id").alias("total_transactions"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"),
        F.sum("is_returned").alias("_ret"), F.count("is_returned").alias("_nr"))
    return g.select(
        "year", "month", "month_name", "product_category",
        (F.coalesce(F.col("_rev"), F.lit(0)).cast("double") / 100.0).alias("total_revenue"),
        "total_transactions",
        X.mean_double(F.col("_fin"), F.col("_nf") * 100).alias("avg_order_value"),
        X.mean_double(F.col("_ret"), F.col("_nr")).alias("return_rate")) \
        .orderBy("year", "month", "month_name", "product_category")
