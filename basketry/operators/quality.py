"""Data-quality validation (survey Q1-Q8).

The row rules of a table are one global aggregate (one ``count_if`` each, summed
map side); only key uniqueness groups by the key, one count per row.
The orphan check is one anti join.  The result is a small DataFrame
(check, violations, passed) instead of log lines, closed by an
``all_checks`` verdict row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

# The domains asserted by the reference's tests.
VALID_SEGMENTS = ["Premium", "Regular", "Occasional", "New"]
CUSTOMER_KEY_COLUMNS = ["customer_id", "age", "segment", "region"]
TRANSACTION_KEY_COLUMNS = ["transaction_id", "customer_id", "final_amount"]


def _stack(one_row: DataFrame) -> DataFrame:
    cols = one_row.columns
    return one_row.select(*[F.col(c).cast("bigint") for c in cols]) \
        .unpivot([], cols, "check", "violations")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Q7: number of key values that occur more than once."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("violations")) \
        .select(F.lit(f"duplicate_{key}").alias("check"), "violations")


def _keyed_checks(df: DataFrame, key: str, rules: dict) -> DataFrame:
    """Rule name -> violating rows, ``duplicate_<key>`` -> keys held by more than one row.

    The rules shuffle one partial row per task; the key shuffle carries keys and counts only.
    """
    one = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    return _stack(one).unionByName(duplicate_keys(df, key))


def customer_rules() -> dict:
    """Q1 + the customer part of Q8."""
    rules = {f"customer_null_{c}": F.col(c).isNull() for c in CUSTOMER_KEY_COLUMNS}
    rules.update({
        "customer_age_out_of_range": (F.col("age") < 18) | (F.col("age") > 100),
        "customer_invalid_segment": ~F.col("segment").isin(VALID_SEGMENTS),
        "customer_is_churned_not_binary": ~F.col("is_churned").isin(0, 1),
    })
    return rules


def transaction_rules() -> dict:
    """Q2, Q4 + the transaction part of Q8."""
    rules = {f"transaction_null_{c}": F.col(c).isNull() for c in TRANSACTION_KEY_COLUMNS}
    rules.update({
        "transaction_negative_amount": F.col("final_amount") < 0,
        "transaction_discount_out_of_range": (F.col("discount_percent") < 0)
        | (F.col("discount_percent") > 100),
        "transaction_rating_out_of_range": (F.col("rating") < 1) | (F.col("rating") > 5),
        "transaction_is_returned_not_binary": ~F.col("is_returned").isin(0, 1),
    })
    return rules


def customer_checks(customers: DataFrame) -> DataFrame:
    return _keyed_checks(customers, "customer_id", customer_rules())


def transaction_checks(transactions: DataFrame) -> DataFrame:
    return _keyed_checks(transactions, "transaction_id", transaction_rules())


def orphan_keys(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """The distinct customer ids of transactions (NULL included) that no customer has."""
    keys = transactions.select("customer_id").distinct()
    return keys.join(customers.select("customer_id"), "customer_id", "left_anti")


def orphan_transactions(transactions: DataFrame, customers: DataFrame, broadcast_keys: int = 1_000_000,
                        keys_from: DataFrame | None = None) -> DataFrame:
    """Transactions whose customer_id is absent (a NULL id is an orphan too).

    ``keys_from`` (default: the transactions) holds at least their customer ids: the rows before they
    were cleaned, say, whose ids are cheaper to list.

    The distinct keys meet the customers first; only the orphan keys, written to the
    checkpoint folder and counted, meet the rows.  Up to ``broadcast_keys`` of them the transactions are
    not shuffled at all; beyond that a shuffle join takes over.
    """
    ensure_checkpoint_dir(transactions.sparkSession)
    keys = orphan_keys(transactions if keys_from is None else keys_from, customers).withColumnRenamed("customer_id", "_orphan").checkpoint(eager=True)
    side = F.broadcast(keys) if keys.count() <= broadcast_keys else keys
    return transactions.join(side, F.col("customer_id").eqNullSafe(F.col("_orphan")), "left_semi")


#: Columns that the rules read.
CUSTOMER_RULE_COLUMNS = ["customer_id", "age", "segment", "is_churned"]
TRANSACTION_RULE_COLUMNS = ["transaction_id", "customer_id", "final_amount", "discount_percent", "rating", "is_returned"]


def _narrow(df: DataFrame, columns) -> DataFrame:
    return df.select(*[c for c in df.columns if c in set(columns)])


def quality_report(customers: DataFrame, transactions: DataFrame,
                   materialize: bool = True) -> DataFrame:
    """Q6: every check with its violation count and a pass flag, plus the verdict row.

    Both inputs feed several independent aggregations; with ``materialize``
    the columns that the rules read are written once to the reliable checkpoint folder
    (lineage cut), so the upstream cleaning is not re-run per check.
    """
    customers = _narrow(customers, [*CUSTOMER_RULE_COLUMNS, *CUSTOMER_KEY_COLUMNS])
    transactions = _narrow(transactions, [*TRANSACTION_RULE_COLUMNS, *TRANSACTION_KEY_COLUMNS])
    if materialize:
        ensure_checkpoint_dir(customers.sparkSession)
        customers = customers.checkpoint(eager=True)
        transactions = transactions.checkpoint(eager=True)
    orphans = orphan_transactions(transactions, customers) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("violations")) \
        .select(F.lit("orphan_transactions").alias("check"), "violations")
    checks = (customer_checks(customers)
              .unionByName(transaction_checks(transactions))
              .unionByName(orphans))
    checks = checks.withColumn("passed", F.col("violations") == 0)
    verdict = checks.agg(F.count_if(~F.col("passed")).cast("bigint").alias("violations")) \
        .select(F.lit("all_checks").alias("check"), "violations",
                (F.col("violations") == 0).alias("passed"))
    return checks.unionByName(verdict)


def validate(customers: DataFrame, transactions: DataFrame) -> bool:
    """``validate_data`` verdict: True when no check found a violation (one-row aggregate)."""
    row = quality_report(customers, transactions).where(F.col("check") == "all_checks").first()
    return bool(row["passed"])


def profile(df: DataFrame, date_col: str | None = None) -> DataFrame:
    """Q5: total rows, NULL count of every column and the date range, in one pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    if date_col:
        aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.agg(*aggs)
