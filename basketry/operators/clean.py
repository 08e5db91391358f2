"""Cleaning and filters (survey C1-C12).

``dedup_first`` first counts the keys alone.  Rows of keys that occur once pass as they
are; only the rows of repeated keys are aggregated (the minimum of one struct, order columns
first): partial aggregation runs map side, so a key repeated a billion times still
leaves one row per map task, and no task has to buffer a whole key group.  Where many keys
repeat, or the rows come out of joins that counting would run again, all rows are aggregated so,
in one pass and one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import exprs as X
from basketry.session import ensure_checkpoint_dir


def dedup_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str], broadcast_keys: int = 1_000_000,
                columns: Sequence[str] | None = None) -> DataFrame:
    """``drop_duplicates(subset=key)`` keeping the first row in ``order``.

    pandas groups NULL keys together as one key; so does ``groupBy``.  The repeated keys are
    written to the checkpoint folder and counted: up to ``broadcast_keys`` of them the other rows are
    not shuffled at all, beyond that all rows go through one aggregation.  0 goes there at once, without
    counting.  ``columns`` (default: all) are the ones wanted: the same rows are kept, but an exchange
    carries no column that neither they nor the order among equal rows before them need.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # The declared order first (readers make ingest_seq unique), then the rest
    # of the row, so the kept row is deterministic even on exact ties.
    first = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    if columns is not None:
        # a struct's minimum starts with the minimum of its first fields
        rest = rest[:max((rest.index(c) + 1 for c in columns if c in rest), default=0)]
        df = df.select(*[c for c in df.columns if c in {*keys, *first, *rest}])

    def kept(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("_first"))
                .select(*keys, "_first.*").select(*df.columns))

    if broadcast_keys <= 0:
        return kept(df)
    ensure_checkpoint_dir(df.sparkSession)
    again = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
             .select(*[F.col(k).alias(f"_again{i}") for i, k in enumerate(keys)]).checkpoint(eager=True))
    n = again.count()
    if not n:
        return df
    if n > broadcast_keys:
        return kept(df)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_again{i}"))
    side = F.broadcast(again)
    return df.join(side, same, "left_anti").unionByName(kept(df.join(side, same, "left_semi")))


def _once(df: DataFrame) -> DataFrame:
    """The median and the result both read the deduplicated rows: sort them out once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def median_value(df: DataFrame, col: str):
    """Exact median as a driver-side scalar (a one-row aggregate).

    ``percentile`` keeps a value -> count map; use it for bounded domains
    (ages).  High-cardinality columns go through ``ranking.exact_quantiles``.
    """
    return df.agg(F.percentile(F.col(col), 0.5).alias("m")).first()["m"]


def median_high_cardinality(df: DataFrame, col: str):
    from basketry.operators import ranking
    return ranking.exact_quantiles(df, col, [0.5], prefix="m").first()["m0"]


def row_counts(before: DataFrame, after: DataFrame) -> dict:
    """Rows before -> after and removed (two count jobs).

    ``DataFrame.observe`` would avoid the extra scan, but in this Spark
    version a registered Observation makes later reliable checkpoints of the
    session fail to serialize, so plain counts are used.
    """
    n_in, n_out = before.count(), after.count()
    return {"before": n_in, "after": n_out, "removed": n_in - n_out}


def clean_customers(df: DataFrame, tenure_date, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """C6 = C1 -> C2 -> C3 -> C4 -> P11 -> P16 -> P10, in the reference's order."""
    order = [c for c in order if c in df.columns]
    d = _once(dedup_first(df, "customer_id", order))
    med = median_value(d, "age")                       # after dedup, before the range filter
    d = d.withColumn("age", F.coalesce(F.col("age").cast("double"),
                                       F.lit(None if med is None else float(med))))
    d = d.fillna({"gender": "Unknown"}).withColumn(
        "loyalty_points", F.coalesce(F.col("loyalty_points"), F.lit(0)))
    d = d.where((F.col("age") >= 18) & (F.col("age") <= 100))
    d = d.withColumn("age_group", X.age_group("age"))
    for c in ("gender", "segment", "region"):
        d = d.withColumn(c, X.normalise_text(c))
    d = d.withColumn("tenure_days", X.date_days_between(X.as_date(tenure_date), F.col("join_date")))
    return d.drop("ingest_seq") if "ingest_seq" in d.columns else d


def add_transaction_features(df: DataFrame) -> DataFrame:
    """P2-P6, P1, P12 on (already filtered) transactions."""
    d = F.col("transaction_date")
    return (df
            .withColumn("year", F.year(d))
            .withColumn("month", F.month(d))
            .withColumn("month_name", X.month_name(d))
            .withColumn("quarter", F.quarter(d))
            .withColumn("day_of_week", X.day_name(d))
            .withColumn("is_weekend", X.is_weekend(d))
            .withColumn("week_of_year", F.weekofyear(d))
            .withColumn("revenue", F.col("final_amount") * F.col("quantity"))
            .withColumn("discount_bucket", X.discount_bucket("discount_percent")))


def clean_transactions(df: DataFrame, order: Sequence[str] = ("ingest_seq", "final_amount", "quantity"),
                       columns: Sequence[str] | None = None) -> DataFrame:
    """C7 = C1 -> C5 -> P17 -> P2..P6 -> P1 -> P12.

    Transactions come out of joins, so C1 does not count their keys first.  ``columns`` (of the
    input; default: all columns and features) are the ones wanted of the same rows.
    """
    order = [c for c in order if c in df.columns]
    d = dedup_first(df, "transaction_id", order, broadcast_keys=0, columns=columns)
    d = d.where((F.col("final_amount") > 0) & (F.col("quantity") > 0))
    if columns is None or "discount_percent" in columns:
        d = d.withColumn("discount_percent", X.clip_keep_null("discount_percent", 0, 100)
                         .cast("decimal(5,2)"))
    if columns is not None:
        return d.select(*columns)
    d = add_transaction_features(d)
    return d.drop("ingest_seq") if "ingest_seq" in d.columns else d


def clean_gen1(customers: DataFrame, transactions: DataFrame):
    """Dedup both, median-impute amount, quantity 1, keep amount > 0."""
    c = dedup_first(customers, "customer_id", [o for o in ("ingest_seq",) if o in customers.columns])
    t = _once(dedup_first(transactions, "transaction_id",
                          [o for o in ("ingest_seq", "amount", "quantity") if o in transactions.columns],
                          broadcast_keys=0))
    med = median_high_cardinality(t, "amount")
    t = t.withColumn("amount", F.coalesce(F.col("amount").cast("double"),
                                          F.lit(None if med is None else float(med))))
    t = t.withColumn("quantity", F.coalesce(F.col("quantity"), F.lit(1)))
    t = t.where(F.col("amount") > 0)
    c = c.drop("ingest_seq") if "ingest_seq" in c.columns else c
    t = t.drop("ingest_seq") if "ingest_seq" in t.columns else t
    return c, t


def apply_slicers(transactions: DataFrame, customers: DataFrame | None = None, *,
                  date_from=None, date_to=None, regions=None, segments=None,
                  categories=None, channels=None, risks=None,
                  risk_scores: DataFrame | None = None) -> DataFrame:
    """BI slicers as filters.  Customer attributes filter via a semi join,
    as does the churn risk (``risk_scores``: customer_id, churn_risk)."""
    t = transactions
    if date_from is not None:
        t = t.where(F.col("transaction_date") >= X.as_date(date_from))
    if date_to is not None:
        t = t.where(F.col("transaction_date") <= X.as_date(date_to))
    if categories:
        t = t.where(F.col("product_category").isin(list(categories)))
    if channels:
        t = t.where(F.col("channel").isin(list(channels)))
    if customers is not None and (regions or segments):
        c = customers
        if regions:
            c = c.where(F.col("region").isin(list(regions)))
        if segments:
            c = c.where(F.col("segment").isin(list(segments)))
        t = t.join(c.select("customer_id"), "customer_id", "left_semi")
    if risks:
        at_risk = risk_scores.where(F.col("churn_risk").isin(list(risks)))
        t = t.join(at_risk.select("customer_id"), "customer_id", "left_semi")
    return t
