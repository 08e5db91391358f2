"""Oracle SQL of the deterministic parts of the model jobs and the workbook tables.

The model-dependent inputs are replaced by fixed ones that SQL can state: a
cluster is the customer number modulo 4, a churn probability is
d / (d + 180) of the days idle.
"""

from __future__ import annotations

from basketry.plans.oracle import CENTS, RR
from basketry.plans.oracle_queries import _ACTIVITY, REV, SQL

_HE = "half_even"

_PROBABILITY = _ACTIVITY + """
, risk AS (
SELECT customer_id, segment, region, is_churned, round_even(p, 4) AS churn_probability,
       CASE WHEN round_even(p, 4) > -0.01 AND round_even(p, 4) <= 0.3 THEN 'Low Risk'
            WHEN round_even(p, 4) > 0.3 AND round_even(p, 4) <= 0.6 THEN 'Medium Risk'
            WHEN round_even(p, 4) > 0.6 AND round_even(p, 4) <= 1.01 THEN 'High Risk' END AS churn_risk
FROM (SELECT *, CAST(days_since_last_purchase AS DOUBLE)
                / (CAST(days_since_last_purchase AS DOUBLE) + 180.0) AS p
      FROM activity WHERE days_since_last_purchase IS NOT NULL)
)
"""

_CLUSTERED = f"""
, points AS (
SELECT r.customer_id, r.recency, r.frequency, r.monetary, c.loyalty_points,
       CAST(CAST(substr(r.customer_id, 5) AS BIGINT) % 4 AS INTEGER) AS cluster
FROM ({SQL["rfm_gen1"]}) r JOIN customers c ON r.customer_id = c.customer_id
), means AS (
SELECT cluster, avg(monetary) AS m, avg(recency) AS r FROM points GROUP BY cluster
), named AS (
SELECT cluster, CASE least(rank() OVER (ORDER BY m DESC), 4)
                WHEN 1 THEN 'High-Value Champions' WHEN 2 THEN 'Loyal Mid-Tier'
                WHEN 3 THEN 'Price-Sensitive Bargain Hunters' ELSE 'Dormant / At-Risk' END AS segment_label
FROM means
)
"""

SQL["churn_risk_scores"] = _PROBABILITY + "SELECT * FROM risk"
SQL["risk_list"] = _PROBABILITY + "SELECT * FROM risk WHERE churn_risk = 'High Risk'"
SQL["high_risk_count"] = _PROBABILITY + \
    "SELECT COUNT(*) FILTER (WHERE churn_risk = 'High Risk') AS high_risk_customers FROM risk"
SQL["sliced_by_risk"] = _PROBABILITY + f"""
SELECT product_category, channel, COUNT(transaction_id) AS transactions,
       {RR(f"SUM({CENTS(REV)})", "100", 2)} AS revenue
FROM transactions WHERE customer_id IN (SELECT customer_id FROM risk WHERE churn_risk = 'High Risk')
GROUP BY product_category, channel
"""

SQL["excel_category"] = f"""
SELECT product_category AS category,
       {RR(f"COALESCE(SUM({CENTS(REV)}), 0)", "100", 2, _HE)} AS revenue,
       COUNT(transaction_id) AS orders,
       {RR(f"SUM({CENTS('final_amount')})", "100 * COUNT(final_amount)", 2, _HE)} AS avg_value,
       {RR("SUM(rating)", "COUNT(rating)", 2, _HE)} AS avg_rating,
       {RR("100 * SUM(is_returned)", "COUNT(is_returned)", 2, _HE)} AS return_rate_pct
FROM transactions WHERE product_category IS NOT NULL GROUP BY product_category
"""

SQL["excel_kpis"] = f"""
, kc AS (
SELECT COUNT(*) AS nc, SUM(is_churned) AS ch, COUNT(is_churned) AS nch,
       COUNT(*) FILTER (WHERE is_churned = 0) AS active FROM customers
), kt AS (
SELECT COUNT(*) AS nt, COALESCE(SUM({CENTS(REV)}), 0) AS rev, SUM({CENTS('final_amount')}) AS fin,
       COUNT(final_amount) AS nf, SUM(is_returned) AS ret, COUNT(is_returned) AS nret,
       SUM(rating) AS rat, COUNT(rating) AS nrat FROM transactions
), kv AS (SELECT * FROM kc, kt)
SELECT 'Total Customers' AS KPI, CAST(nc AS DOUBLE) AS Value FROM kv
UNION ALL SELECT 'Total Transactions', CAST(nt AS DOUBLE) FROM kv
UNION ALL SELECT 'Total Revenue', {RR('rev', '100', 0, _HE)} FROM kv
UNION ALL SELECT 'Avg Order Value', {RR('fin', '100 * nf', 2, _HE)} FROM kv
UNION ALL SELECT 'Avg Rating', {RR('rat', 'nrat', 2, _HE)} FROM kv
UNION ALL SELECT 'Churn Rate', {RR('100 * ch', 'nch', 1, _HE)} FROM kv
UNION ALL SELECT 'Return Rate', {RR('100 * ret', 'nret', 1, _HE)} FROM kv
UNION ALL SELECT 'Active Customers', CAST(active AS DOUBLE) FROM kv
"""

SQL["null_profile"] = """
SELECT COUNT(*) AS total_rows,
""" + ",\n".join(f"       COUNT(*) - COUNT({c}) AS null_{c}" for c in
                 ("transaction_id", "customer_id", "date", "category", "amount", "quantity", "returned")) + """,
       MIN(date) AS min_date, MAX(date) AS max_date
FROM raw_gen1_transactions
"""

SQL["cluster_names_fixed"] = _CLUSTERED + """
SELECT p.customer_id, p.cluster, n.segment_label FROM points p JOIN named n ON p.cluster = n.cluster"""
SQL["cluster_names_gen1_fixed"] = _CLUSTERED + """
SELECT customer_id, cluster,
       CASE WHEN cluster = (SELECT arg_min(cluster, r) FROM means) THEN 'At Risk'
            WHEN cluster = (SELECT arg_max(cluster, m) FROM means) THEN 'Champions'
            ELSE 'Regular' END AS segment_label
FROM points"""
SQL["cluster_summary_fixed"] = _CLUSTERED + """
SELECT p.cluster, n.segment_label, COUNT(customer_id) AS customer_count,
       round(avg(monetary), 2) AS avg_monetary, round(avg(frequency), 2) AS avg_frequency,
       round(avg(recency), 2) AS avg_recency, round(avg(loyalty_points), 2) AS avg_loyalty
FROM points p JOIN named n ON p.cluster = n.cluster GROUP BY p.cluster, n.segment_label"""
SQL["cluster_profile_fixed"] = _CLUSTERED + """
, prof AS (
SELECT cluster, avg(recency) AS recency, avg(frequency) AS frequency, avg(monetary) AS monetary
FROM points GROUP BY cluster
)
SELECT cluster, """ + ", ".join(f"round({c}, 6) AS {c}" for c in ("recency", "frequency", "monetary")) + ", " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9), 6) AS {c}_norm"
    for c in ("recency", "frequency", "monetary")) + " FROM prof"
SQL["gen1_churn_label"] = f"""
SELECT customer_id, recency, CAST(CASE WHEN recency > 180 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM ({SQL["rfm_gen1"]})"""
SQL["standardised_features"] = f"""
, f AS (SELECT customer_id, CAST(recency AS DOUBLE) AS a, CAST(frequency AS DOUBLE) AS b, monetary AS c
        FROM ({SQL["rfm_gen1"]}))
SELECT customer_id, """ + ", ".join(f"round(({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER (), 6) AS z_{n}"
                                    for x, n in (("a", "recency"), ("b", "frequency"), ("c", "monetary"))) + " FROM f"


def _code(column: str, fill: str) -> str:
    return (f"CAST((SELECT COUNT(DISTINCT coalesce(o.{column}, '{fill}')) FROM full_360 o "
            f"WHERE coalesce(o.{column}, '{fill}') < coalesce(f.{column}, '{fill}')) AS DOUBLE)")


SQL["label_encoding"] = SQL["customer_360_rfm"].replace(
    "\nSELECT c.*, r.recency", "\n, full_360 AS (\nSELECT c.*, r.recency") + f"""
)
SELECT customer_id, {_code('gender', 'Unknown')} AS gender_enc, {_code('region', 'Unknown')} AS region_enc,
       {_code('segment', 'Regular')} AS segment_enc, CAST(is_churned AS INTEGER) AS label
FROM full_360 f
WHERE age IS NOT NULL AND loyalty_points IS NOT NULL AND tenure_days IS NOT NULL AND recency IS NOT NULL
  AND frequency IS NOT NULL AND monetary IS NOT NULL AND rfm_score IS NOT NULL AND is_churned IS NOT NULL
"""
