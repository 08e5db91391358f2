"""Report aggregations (survey K1-K3, R1-R21, O2-O3).

Rounded averages use ``round_ratio`` on exact integer sums (cents for money),
so a tie is a real tie and rounds half-up like SQL ``ROUND`` (or half-even
for the pandas-derived Excel tables), independent of float noise.

Transaction-only reports are one ``groupBy`` over transactions (map-side
partial aggregation, one shuffle of partial rows).  Reports over
``customers LEFT JOIN transactions`` use the per-customer pre-aggregate of
``features.customer_txn_stats`` (see that module for the weighting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import exprs as X
from basketry.operators.features import customer_txn_stats, revenue
from basketry.operators.frames import combine_rows
from basketry.session import ensure_checkpoint_dir

#: Columns of transactions that the executive KPIs read.
KPI_COLUMNS = ("transaction_id", "customer_id", "transaction_date", "final_amount", "quantity", "rating", "is_returned")

RR = X.round_ratio


def _txn_sums(t: DataFrame, keys, price_col: str = "final_amount") -> DataFrame:
    cols = set(t.columns)
    aggs = [F.count("transaction_id").alias("_n"),
            F.count(F.lit(1)).alias("_rows"),
            F.sum(X.cents(revenue(price_col))).alias("_rev"),
            F.sum(X.cents(F.col(price_col))).alias("_fin"), F.count(price_col).alias("_nf")]
    if "rating" in cols:
        aggs += [F.sum("rating").alias("_rat"), F.count("rating").alias("_nrat")]
    if "discount_percent" in cols:
        aggs += [F.sum(X.cents(F.col("discount_percent"))).alias("_disc"),
                 F.count("discount_percent").alias("_ndisc")]
    ret = "is_returned" if "is_returned" in cols else "returned"
    if ret in cols:
        aggs += [F.sum(ret).alias("_ret"), F.count(ret).alias("_nret")]
    return t.groupBy(*keys).agg(*aggs)


def _money(c):
    return RR(F.col(c), F.lit(100), 2)


def _avg_money(total, n, digits=2, mode="half_up"):
    return RR(F.col(total), F.col(n) * 100, digits, mode)


def _pct(total, n):
    return RR(F.col(total) * 100, F.col(n), 2)


# ---------------------------------------------------------------------------
# Executive KPIs
# ---------------------------------------------------------------------------
def kpi_summary(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """K2: executive KPI row over ``customers LEFT JOIN transactions`` (T15 weights).

    The sums go by customer and the distinct ids by id, which no single exchange serves: the
    columns that both read are written to the checkpoint folder once, so each source is scanned once.
    """
    ensure_checkpoint_dir(customers.sparkSession)
    customers = customers.select("customer_id", "segment", "is_churned").checkpoint(eager=True)
    transactions = transactions.select(*[c for c in transactions.columns if c in KPI_COLUMNS]).checkpoint(eager=True)
    stats = customer_txn_stats(transactions)
    j = customers.join(stats, "customer_id", "left") \
        .withColumn("_w", F.coalesce(F.col("n_rows"), F.lit(1)))
    # A LEFT JOIN keeps every customer, so the customer distincts are taken
    # on customers alone (no Expand over the joined rows).
    people = customers.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct(F.when(F.col("segment") == "Premium", F.col("customer_id")))
        .alias("premium_customers"))
    main = j.agg(
        F.sum("rev_cents").alias("_rev"),
        F.sum("price_cents").alias("_fin"), F.sum("n_price").alias("_nf"),
        F.sum("rating_sum").alias("_rat"), F.sum("n_rating").alias("_nrat"),
        F.sum("ret_sum").alias("_ret"), F.sum("n_ret").alias("_nret"),
        F.sum(F.col("is_churned") * F.col("_w")).alias("_ch"),
        F.sum(F.when(F.col("is_churned").isNotNull(), F.col("_w"))).alias("_nch"))
    # COUNT(DISTINCT t.transaction_id) over the join = distinct ids of matched rows.
    matched = transactions.join(customers.select("customer_id"), "customer_id", "left_semi")
    distinct_txn = matched.agg(F.count_distinct("transaction_id").alias("total_transactions"))
    one = combine_rows(people, main, distinct_txn)
    return one.select(
        "total_customers", "total_transactions",
        _money("_rev").alias("total_revenue"),
        _avg_money("_fin", "_nf").alias("avg_order_value"),
        RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_customer_rating"),
        _pct("_ret", "_nret").alias("return_rate_pct"),
        _pct("_ch", "_nch").alias("churn_rate_pct"),
        "premium_customers")


KPI_NAMES = ["Total Customers", "Total Transactions", "Total Revenue", "Avg Order Value",
             "Avg Transactions/Customer", "Return Rate (%)", "Avg Customer Rating",
             "Churn Rate (%)", "Active Customers", "Premium Customers"]


def kpi_customer_weighted(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """K1 + W5: the 10-KPI dict as a (KPI, Value) table, customer-weighted churn.

    pandas rounding (half-even on the exact value).
    """
    c = customers.agg(
        F.count(F.lit(1)).alias("_nc"),
        F.sum("is_churned").alias("_ch"), F.count("is_churned").alias("_nch"),
        F.count_if(F.col("is_churned") == 0).alias("_active"),
        F.count_if(F.col("segment") == "Premium").alias("_premium"))
    t = transactions.agg(
        F.count(F.lit(1)).alias("_nt"),
        F.coalesce(F.sum(X.cents(revenue())), F.lit(0)).alias("_rev"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"),
        F.sum("is_returned").alias("_ret"), F.count("is_returned").alias("_nret"),
        F.sum("rating").alias("_rat"), F.count("rating").alias("_nrat"))
    one = combine_rows(c, t)
    he = "half_even"
    values = [
        F.col("_nc").cast("double"),
        F.col("_nt").cast("double"),
        RR(F.col("_rev"), F.lit(100), 2, he),
        RR(F.col("_fin"), F.col("_nf") * 100, 2, he),
        RR(F.col("_nt"), F.col("_nc"), 1, he),
        RR(F.col("_ret") * 100, F.col("_nret"), 2, he),
        RR(F.col("_rat"), F.col("_nrat"), 2, he),
        RR(F.col("_ch") * 100, F.col("_nch"), 2, he),
        F.col("_active").cast("double"),
        F.col("_premium").cast("double"),
    ]
    wide = one.select(*[v.alias(f"k{i}") for i, v in enumerate(values)])
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("KPI"), F.col(f"k{i}").alias("Value"))
        for i, name in enumerate(KPI_NAMES)])).alias("kv"))
    return stacked.select("kv.KPI", "kv.Value")


# ---------------------------------------------------------------------------
# Transaction-only reports (gen 2)
# ---------------------------------------------------------------------------
def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """By STRFTIME('%Y'), STRFTIME('%m') strings."""
    # Group on the first day of the month (an int-backed date) and format the
    # two string keys once per group instead of once per row.
    t = transactions.withColumn("_m", F.trunc("transaction_date", "MM"))
    g = _txn_sums(t, ["_m"])
    return g.select(F.date_format("_m", "yyyy").alias("year"), F.date_format("_m", "MM").alias("month"),
                    F.col("_n").alias("transaction_count"),
                    _money("_rev").alias("revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating"),
                    _pct("_ret", "_nret").alias("return_rate_pct")) \
        .orderBy("year", "month")


def category_performance(transactions: DataFrame) -> DataFrame:
    """R5 + N3: revenue share = SUM(SUM(rev)) OVER () on the per-category rows."""
    g = _txn_sums(transactions, ["product_category"])
    everything = Window.partitionBy()  # input is one row per category
    g = g.withColumn("_total", F.sum("_rev").over(everything))
    return g.select("product_category", F.col("_n").alias("total_orders"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    _avg_money("_disc", "_ndisc").alias("avg_discount_pct"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating"),
                    _pct("_ret", "_nret").alias("return_rate_pct"),
                    RR(F.col("_rev") * 100, F.col("_total"), 2).alias("revenue_share_pct")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "product_category")


def channel_performance(transactions: DataFrame) -> DataFrame:
    """R12 + N3: volume share of COUNT(transaction_id)."""
    g = _txn_sums(transactions, ["channel"])
    g = g.withColumn("_total", F.sum("_n").over(Window.partitionBy()))
    return g.select("channel", F.col("_n").alias("transaction_count"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    _avg_money("_disc", "_ndisc").alias("avg_discount"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating"),
                    _pct("_ret", "_nret").alias("return_rate_pct"),
                    RR(F.col("_n") * 100, F.col("_total"), 2).alias("volume_share_pct")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "channel")


def payment_methods(transactions: DataFrame) -> DataFrame:
    """R15."""
    g = _txn_sums(transactions, ["payment_method"])
    return g.select("payment_method", F.col("_n").alias("transaction_count"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_transaction_value"),
                    _avg_money("_disc", "_ndisc").alias("avg_discount"),
                    _pct("_ret", "_nret").alias("return_rate_pct")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "payment_method")


def weekend_weekday(transactions: DataFrame) -> DataFrame:
    """Saturday/Sunday vs the rest."""
    t = transactions.withColumn("day_type", X.weekend_label("transaction_date"))
    g = _txn_sums(t, ["day_type"])
    return g.select("day_type", F.col("_n").alias("transaction_count"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "day_type")


# ---------------------------------------------------------------------------
# customers LEFT JOIN transactions reports (T15 weighting)
# ---------------------------------------------------------------------------
def _weighted_by(customers: DataFrame, transactions: DataFrame, key: str) -> DataFrame:
    stats = customer_txn_stats(transactions)
    j = customers.join(stats, "customer_id", "left") \
        .withColumn("_w", F.coalesce(F.col("n_rows"), F.lit(1)))

    def wsum(c):
        return F.sum(F.col(c) * F.col("_w"))

    def wn(c):
        return F.sum(F.when(F.col(c).isNotNull(), F.col("_w")))

    return j.groupBy(key).agg(
        F.count_distinct("customer_id").alias("_customers"),
        wsum("age").alias("_age"), wn("age").alias("_nage"),
        wsum("loyalty_points").alias("_lp"), wn("loyalty_points").alias("_nlp"),
        wsum("is_churned").alias("_ch"), wn("is_churned").alias("_nch"),
        F.sum("rev_cents").alias("_rev"),
        F.sum("price_cents").alias("_fin"), F.sum("n_price").alias("_nf"),
        F.coalesce(F.sum("n_txn"), F.lit(0)).alias("_n"),
        F.sum("rating_sum").alias("_rat"), F.sum("n_rating").alias("_nrat"))


def segment_analysis(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """R8."""
    g = _weighted_by(customers, transactions, "segment")
    return g.select("segment", F.col("_customers").alias("customer_count"),
                    RR(F.col("_age"), F.col("_nage"), 1).alias("avg_age"),
                    RR(F.col("_lp"), F.col("_nlp"), 0).alias("avg_loyalty_points"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    F.col("_n").alias("total_transactions"),
                    _pct("_ch", "_nch").alias("churn_rate_pct"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "segment")


def regional_performance(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """R14."""
    g = _weighted_by(customers, transactions, "region")
    return g.select("region", F.col("_customers").alias("total_customers"),
                    F.col("_n").alias("total_orders"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf").alias("avg_order_value"),
                    _pct("_ch", "_nch").alias("churn_rate_pct"),
                    RR(F.col("_rat"), F.col("_nrat"), 2).alias("avg_rating")) \
        .orderBy(F.desc_nulls_last("total_revenue"), "region")


def churn_risk_flags(customers: DataFrame, transactions: DataFrame, snapshot) -> DataFrame:
    """Every customer with idle days and a risk flag (NULL days -> 'Low Risk')."""
    stats = customer_txn_stats(transactions)
    j = customers.join(stats, "customer_id", "left")
    days = X.date_days_between(X.as_date(snapshot), F.col("last_date"))
    return j.select(
        "customer_id", "segment", "region",
        days.alias("days_since_last_purchase"),
        F.coalesce(F.col("n_txn"), F.lit(0)).alias("total_transactions"),
        RR(F.col("rating_sum"), F.col("n_rating"), 2).alias("avg_rating"),
        "loyalty_points", "is_churned",
        X.idle_risk_flag(days).alias("churn_risk_flag")) \
        .orderBy(F.desc_nulls_last("days_since_last_purchase"), "customer_id")


def top_customers_ltv(customers: DataFrame, transactions: DataFrame, n: int = 20) -> DataFrame:
    """O2: top-n by lifetime value over non-returned purchases (inner join).

    ``orderBy(...).limit(n)`` plans TakeOrderedAndProject: each task keeps its
    own top n, only n rows per task reach the final merge.
    """
    stats = customer_txn_stats(transactions.where(F.col("is_returned") == 0))
    j = customers.join(stats, "customer_id", "inner")
    out = j.select(
        "customer_id", "age", "gender", "segment", "region", "loyalty_points",
        F.col("n_txn").alias("total_orders"),
        X.round_ratio(F.col("rev_cents"), F.lit(100), 2).alias("lifetime_value"),
        X.round_ratio(F.col("price_cents"), F.col("n_price") * 100, 2).alias("avg_order_value"),
        X.round_ratio(F.col("rating_sum"), F.col("n_rating"), 2).alias("avg_rating"),
        F.col("last_date").alias("last_purchase"))
    return out.orderBy(F.col("lifetime_value").desc_nulls_last(), F.col("customer_id")).limit(n)


# ---------------------------------------------------------------------------
# Cohorts (R19, R20)
# ---------------------------------------------------------------------------
def cohort_first_purchase(transactions: DataFrame) -> DataFrame:
    """Distinct active customers per (first-purchase month, activity month).

    Transactions are first reduced to distinct (customer, month) pairs, so a
    customer contributes at most one row per month to every later shuffle.
    """
    active = transactions.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.trunc("transaction_date", "MM").alias("_act")).distinct()
    first = Window.partitionBy("customer_id")
    cohorts = active.withColumn("_coh", F.min("_act").over(first))
    g = cohorts.groupBy("_coh", "_act").agg(F.count("customer_id").alias("active_customers"))
    return g.select(X.month_key("_coh").alias("cohort_month"),
                    X.month_key("_act").alias("activity_month"), "active_customers") \
        .orderBy("cohort_month", "activity_month")


def cohort_join_month(customers: DataFrame, transactions: DataFrame,
                      date_col: str = "date") -> DataFrame:
    """R20 (gen 1): cohort = join month; inner join; distinct active customers."""
    active = transactions.select(
        "customer_id", F.trunc(date_col, "MM").alias("_act")).distinct()
    c = customers.select("customer_id", F.trunc("join_date", "MM").alias("_coh"))
    j = c.join(active, "customer_id")
    g = j.groupBy("_coh", "_act").agg(F.count_distinct("customer_id").alias("active_customers"))
    return g.select(X.month_key("_coh").alias("cohort_month"),
                    X.month_key("_act").alias("activity_month"), "active_customers") \
        .orderBy("cohort_month", "activity_month")


# ---------------------------------------------------------------------------
# Gen-1 SQL reports (MySQL dialect, amount instead of final_amount)
# ---------------------------------------------------------------------------
def monthly_revenue_net(transactions: DataFrame) -> DataFrame:
    """R2: non-returned, by yyyy-MM; AVG(decimal) keeps 6 decimals as in MySQL."""
    t = transactions.where(F.col("returned") == 0).withColumn("_m", F.trunc("date", "MM"))
    g = _txn_sums(t, ["_m"], price_col="amount")
    return g.select(X.month_key("_m").alias("month"), F.col("_n").alias("total_orders"),
                    _money("_rev").alias("total_revenue"),
                    _avg_money("_fin", "_nf", 6).alias("avg_order_value")) \
        .orderBy("month")


def top_customers_revenue(customers: DataFrame, transactions: DataFrame, n: int = 10) -> DataFrame:
    """O3 (gen 1)."""
    stats = customer_txn_stats(transactions.where(F.col("returned") == 0), price_col="amount",
                               date_col="date")
    j = customers.join(stats, "customer_id")
    out = j.select("customer_id", "segment", "region", F.col("n_txn").alias("orders"),
                   X.round_ratio(F.col("rev_cents"), F.lit(100), 2).alias("lifetime_value"))
    return out.orderBy(F.col("lifetime_value").desc_nulls_last(), F.col("customer_id")).limit(n)


def category_channel(transactions: DataFrame) -> DataFrame:
    """Revenue by category and channel, for sliced transactions."""
    return _txn_sums(transactions, ["product_category", "channel"]).select(
        "product_category", "channel", F.col("_n").alias("transactions"),
        _money("_rev").alias("revenue"))


def category_returns(transactions: DataFrame) -> DataFrame:
    """R6 (gen 1): SUM(returned) as a count of returns."""
    g = _txn_sums(transactions, ["category"], price_col="amount")
    return g.select("category", F.col("_rows").alias("transactions"),
                    _money("_rev").alias("revenue"),
                    _avg_money("_fin", "_nf").alias("avg_amount"),
                    F.col("_ret").alias("returns")) \
        .orderBy(F.desc_nulls_last("revenue"), "category")


def churn_risk_having(transactions: DataFrame, as_of, idle_days: int = 180) -> DataFrame:
    """R18 (gen 1): HAVING days idle > 180 relative to ``as_of`` (replaces CURDATE())."""
    g = transactions.groupBy("customer_id").agg(
        F.max("date").alias("last_purchase"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(X.cents(revenue("amount"))).alias("_rev"))
    days = X.date_days_between(X.as_date(as_of), F.col("last_purchase"))
    return g.select("customer_id", "last_purchase", days.alias("days_since_purchase"),
                    "total_orders", _money("_rev").alias("total_spent")) \
        .where(F.col("days_since_purchase") > idle_days) \
        .orderBy(F.desc_nulls_last("total_spent"), "customer_id")


def segment_return_rate(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """R11 (gen 1): inner join, 100 * SUM(returned) / COUNT(*)."""
    stats = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("transaction_id").alias("_n"),
        F.sum("returned").alias("_ret"))
    g = customers.join(stats, "customer_id").groupBy("segment").agg(
        F.sum("_n").alias("total_transactions"), F.sum("_ret").alias("returned_orders"),
        F.sum("_rows").alias("_rows"))
    return g.select("segment", "total_transactions", "returned_orders",
                    RR(F.col("returned_orders") * 100, F.col("_rows"), 2).alias("return_rate_pct"))


# ---------------------------------------------------------------------------
# pandas-derived chart data and Excel tables
# ---------------------------------------------------------------------------
def monthly_excel(transactions: DataFrame) -> DataFrame:
    """Month, Revenue, Transactions, AOV, pandas half-even rounding."""
    t = transactions.where(F.col("transaction_date").isNotNull()) \
        .withColumn("_m", F.trunc("transaction_date", "MM"))
    g = t.groupBy("_m").agg(
        F.coalesce(F.sum(X.cents(F.col("revenue"))), F.lit(0)).alias("_rev"),
        F.count("transaction_id").alias("transactions"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"))
    return g.select(X.month_key("_m").alias("month"),
                    RR(F.col("_rev"), F.lit(100), 2, "half_even").alias("revenue"),
                    "transactions",
                    RR(F.col("_fin"), F.col("_nf") * 100, 2, "half_even").alias("avg_order_value")) \
        .orderBy("month")


def category_chart(transactions: DataFrame) -> DataFrame:
    """Revenue, count, mean rating, mean return flag per category (unrounded)."""
    t = transactions.where(F.col("product_category").isNotNull())
    g = t.groupBy("product_category").agg(
        F.coalesce(F.sum(X.cents(F.col("revenue"))), F.lit(0)).alias("_rev"),
        F.count("transaction_id").alias("transactions"),
        F.sum("rating").alias("_rat"), F.count("rating").alias("_nrat"),
        F.sum("is_returned").alias("_ret"), F.count("is_returned").alias("_nret"))
    return g.select("product_category", (F.col("_rev").cast("double") / 100.0).alias("revenue"),
                    "transactions",
                    X.mean_double(F.col("_rat"), F.col("_nrat")).alias("avg_rating"),
                    X.mean_double(F.col("_ret"), F.col("_nret")).alias("return_rate")) \
        .orderBy(F.desc("revenue"), "product_category")


def excel_category(transactions: DataFrame) -> DataFrame:
    """R7, workbook form: figures rounded to two digits (half-even), return rate in percent."""
    t = transactions.where(F.col("product_category").isNotNull())
    g = t.groupBy("product_category").agg(
        F.coalesce(F.sum(X.cents(F.col("revenue"))), F.lit(0)).alias("_rev"),
        F.count("transaction_id").alias("orders"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"),
        F.sum("rating").alias("_rat"), F.count("rating").alias("_nrat"),
        F.sum("is_returned").alias("_ret"), F.count("is_returned").alias("_nret"))
    he = "half_even"
    return g.select(F.col("product_category").alias("category"),
                    RR(F.col("_rev"), F.lit(100), 2, he).alias("revenue"), "orders",
                    _avg_money("_fin", "_nf", 2, he).alias("avg_value"),
                    RR(F.col("_rat"), F.col("_nrat"), 2, he).alias("avg_rating"),
                    RR(F.col("_ret") * 100, F.col("_nret"), 2, he).alias("return_rate_pct")) \
        .orderBy(F.desc("revenue"), "category")


EXCEL_KPIS = ["Total Customers", "Total Transactions", "Total Revenue", "Avg Order Value",
              "Avg Rating", "Churn Rate", "Return Rate", "Active Customers"]


def excel_kpis(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """K3: the workbook's eight cards as numbers, in the digits the cards show (half-even)."""
    c = customers.agg(
        F.count(F.lit(1)).alias("_nc"), F.sum("is_churned").alias("_ch"),
        F.count("is_churned").alias("_nch"), F.count_if(F.col("is_churned") == 0).alias("_active"))
    t = transactions.agg(
        F.count(F.lit(1)).alias("_nt"), F.coalesce(F.sum(X.cents(revenue())), F.lit(0)).alias("_rev"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"),
        F.sum("is_returned").alias("_ret"), F.count("is_returned").alias("_nret"),
        F.sum("rating").alias("_rat"), F.count("rating").alias("_nrat"))
    he = "half_even"
    values = [F.col("_nc").cast("double"), F.col("_nt").cast("double"),
              RR(F.col("_rev"), F.lit(100), 0, he), _avg_money("_fin", "_nf", 2, he),
              RR(F.col("_rat"), F.col("_nrat"), 2, he),
              RR(F.col("_ch") * 100, F.col("_nch"), 1, he),
              RR(F.col("_ret") * 100, F.col("_nret"), 1, he), F.col("_active").cast("double")]
    one = combine_rows(c, t).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("KPI"), v.alias("Value"))
        for name, v in zip(EXCEL_KPIS, values, strict=True)])).alias("kv"))
    return one.select("kv.KPI", "kv.Value")


def channel_share(transactions: DataFrame) -> DataFrame:
    """Revenue, count, mean value per channel and the revenue share (pie)."""
    t = transactions.where(F.col("channel").isNotNull())
    g = t.groupBy("channel").agg(
        F.coalesce(F.sum(X.cents(F.col("revenue"))), F.lit(0)).alias("_rev"),
        F.count("transaction_id").alias("count"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"))
    g = g.withColumn("_total", F.sum("_rev").over(Window.partitionBy()))
    return g.select("channel", (F.col("_rev").cast("double") / 100.0).alias("revenue"), "count",
                    X.mean_double(F.col("_fin"), F.col("_nf") * 100).alias("avg_value"),
                    X.mean_double(F.col("_rev") * 100, F.col("_total")).alias("revenue_share_pct")) \
        .orderBy("channel")


def segment_customers(customers: DataFrame) -> DataFrame:
    """Customer-weighted segment table (pandas half-even rounding)."""
    c = customers.where(F.col("segment").isNotNull())
    g = c.groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("age").alias("_age"), F.count("age").alias("_nage"),
        F.sum("loyalty_points").alias("_lp"), F.count("loyalty_points").alias("_nlp"),
        F.sum("is_churned").alias("_ch"), F.count("is_churned").alias("_nch"))
    he = "half_even"
    return g.select("segment", "customer_count",
                    RR(F.col("_age"), F.col("_nage"), 1, he).alias("avg_age"),
                    RR(F.col("_lp"), F.col("_nlp"), 0, he).alias("avg_loyalty"),
                    RR(F.col("_ch") * 100, F.col("_nch"), 2, he).alias("churn_rate")) \
        .orderBy("segment")


def daily_revenue(transactions: DataFrame) -> DataFrame:
    """The BI daily export by date, category, channel."""
    t = transactions.where(F.col("transaction_date").isNotNull()
                           & F.col("product_category").isNotNull() & F.col("channel").isNotNull())
    g = t.groupBy("transaction_date", "product_category", "channel").agg(
        F.coalesce(F.sum(X.cents(F.col("revenue"))), F.lit(0)).alias("_rev"),
        F.count("transaction_id").alias("transactions"),
        F.sum(X.cents(F.col("final_amount"))).alias("_fin"), F.count("final_amount").alias("_nf"))
    return g.select("transaction_date", "product_category", "channel",
                    (F.col("_rev").cast("double") / 100.0).alias("revenue"), "transactions",
                    X.mean_double(F.col("_fin"), F.col("_nf") * 100).alias("avg_value")) \
        .orderBy("transaction_date", "product_category", "channel")
