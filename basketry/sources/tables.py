"""Driver tables -> the reference's customers / transactions (FIXTURES.md §3, §4).

The column mapping is written once as SQL expression text.  Spark evaluates
it with ``selectExpr``; the DuckDB oracle texts in ``basketry.plans.oracle``
wrap the same expressions in a leading ``WITH``.  Only the inputs are shared
this way; every operator on top is implemented separately on each side.

Join strategy: ``region`` (5 rows) and ``nation`` (25 rows) have a fixed size
and are broadcast explicitly.  ``orders``, ``part`` and ``customer`` grow with
the data, so the planner picks the strategy from measured sizes (AQE turns a
sort-merge join into a broadcast join only below the size threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cust_id(key: str) -> str:
    s = f"cast({key} as varchar(20))"
    return f"concat('CUST', lpad({s}, cast(greatest(7, length({s})) as int), '0'))"


# Fixed values of the mapping (FIXTURES.md §3); same text in Spark and DuckDB.
CUSTOMER_EXPRS = {
    "customer_id": _cust_id("c_custkey"),
    "age": "cast(18 + (c_custkey * 37) % 57 as int)",
    "gender": "case when c_custkey % 25 = 0 then 'Other' when c_custkey % 2 = 0 then 'Male' "
              "else 'Female' end",
    "region": "r_name",
    "segment": "case c_mktsegment when 'AUTOMOBILE' then 'Premium' when 'FURNITURE' then "
               "'Occasional' when 'HOUSEHOLD' then 'New' else 'Regular' end",
    "email": "concat('customer', cast(c_custkey as varchar(20)), '@email.com')",
    "join_date": None,  # engine specific, see below
    "loyalty_points": "cast(floor(abs(c_acctbal)) as int)",
    "is_churned": "case when (c_custkey * 7919) % 100 < (case when c_mktsegment = 'FURNITURE' "
                  "then 50 else 15 end) then 1 else 0 end",
}
JOIN_DATE_SPARK = "date_add(date'1994-01-01', cast(c_custkey % 365 as int))"
JOIN_DATE_DUCKDB = "date '1994-01-01' + cast(c_custkey % 365 as int)"

TRANSACTION_EXPRS = {
    "transaction_id": "concat_ws('-', cast(l_orderkey as varchar(20)), cast(l_linenumber as "
                      "varchar(20)), cast(l_partkey as varchar(20)), cast(l_suppkey as varchar(20)))",
    "customer_id": _cust_id("o_custkey"),
    "transaction_date": "cast(o_orderdate as date)",
    "product_category": "p_type",
    "channel": "case l_linenumber % 4 when 0 then 'Online' when 1 then 'In-Store' "
               "when 2 then 'Mobile App' else 'Phone' end",
    "amount": "cast(l_extendedprice as decimal(15,2))",
    "discount_percent": "cast(cast(l_discount as decimal(4,2)) * 250 as decimal(5,2))",
    "final_amount": "cast(round(cast(l_extendedprice as decimal(15,2)) * (1 - cast(cast(l_discount "
                    "as decimal(4,2)) * 250 as decimal(5,2)) * 0.01), 2) as decimal(15,2))",
    "quantity": "cast(l_quantity as int)",
    "rating": "cast(1 + (l_partkey * 3 + l_linenumber) % 5 as int)",
    "is_returned": "case when l_returnflag = 'R' then 1 else 0 end",
    "payment_method": "case o_orderpriority when '1-URGENT' then 'Credit Card' when '2-HIGH' then "
                      "'Debit Card' when '3-MEDIUM' then 'UPI' when '5-LOW' then 'Wallet' "
                      "else 'Cash' end",
}

# Dirty fixture (FIXTURES.md §4): rules keyed on c_custkey / l_partkey.
RAW_CUSTOMER_OVERRIDES = {
    "age": "case when c_custkey % 23 = 0 then null when c_custkey % 29 = 0 then 17 "
           "when c_custkey % 43 = 0 then 101 else {age} end",
    "gender": "case when c_custkey % 31 = 0 then null when c_custkey % 13 = 0 then ' male ' "
              "else {gender} end",
    "loyalty_points": "case when c_custkey % 37 = 0 then null else {loyalty_points} end",
    "region": "case when c_custkey % 7 = 0 then concat('  ', lower(r_name), ' ') else r_name end",
}
RAW_CUSTOMER_DUP_RULE = "c_custkey % 41 = 0"

RAW_TRANSACTION_OVERRIDES = {
    "customer_id": "case when l_partkey % 79 = 0 then 'CUST9999999' when l_partkey % 83 = 0 "
                   "then null else {customer_id} end",
    "final_amount": "cast(case when l_partkey % 59 = 0 then 0 when l_partkey % 47 = 0 then "
                    "-{amount} else {amount} end as decimal(15,2))",
    "quantity": "case when l_partkey % 61 = 0 then 0 else {quantity} end",
    "discount_percent": "cast(case when l_partkey % 73 = 0 then null when l_partkey % 67 = 0 then "
                        "120 when l_partkey % 71 = 0 then -5 else {discount_percent} end "
                        "as decimal(5,2))",
}
RAW_TRANSACTION_DUP_RULE = "transaction_id like '%7'"
# Gen-1 dirty view: the gen-1 cleaner imputes amount (median) and quantity (1).
RAW_GEN1_OVERRIDES = {
    "amount": "case when l_partkey % 73 = 0 then null else final_amount end",
    "quantity": "case when l_partkey % 89 = 0 then null else quantity end",
}

CUSTOMER_COLUMNS = list(CUSTOMER_EXPRS)
TRANSACTION_COLUMNS = list(TRANSACTION_EXPRS)
GEN1_CUSTOMER_COLUMNS = ["customer_id", "age", "region", "segment", "join_date"]
GEN1_TRANSACTION_RENAMES = {"transaction_date": "date", "product_category": "category",
                            "is_returned": "returned"}
GEN1_TRANSACTION_COLUMNS = ["transaction_id", "customer_id", "date", "category", "amount",
                            "quantity", "returned"]


def customer_exprs(engine: str = "spark") -> dict[str, str]:
    exprs = dict(CUSTOMER_EXPRS)
    exprs["join_date"] = JOIN_DATE_SPARK if engine == "spark" else JOIN_DATE_DUCKDB
    return exprs


def raw_customer_exprs(engine: str = "spark") -> dict[str, str]:
    base = customer_exprs(engine)
    out = dict(base)
    for col, template in RAW_CUSTOMER_OVERRIDES.items():
        out[col] = template.format(**base)
    return out


def raw_transaction_exprs() -> dict[str, str]:
    base = dict(TRANSACTION_EXPRS)
    out = dict(base)
    for col, template in RAW_TRANSACTION_OVERRIDES.items():
        out[col] = template.format(**base)
    return out


def _select(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name}" for name, e in exprs.items()])


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (customer
            .join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
            .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))


def _transaction_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (lineitem
            .join(orders, lineitem.l_orderkey == orders.o_orderkey)
            .join(part, lineitem.l_partkey == part.p_partkey))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gen-2 customers (9 columns)."""
    return _select(_customer_base(spark, sf_dir), customer_exprs("spark"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gen-2 transactions (12 columns): every line item of every order."""
    return _select(_transaction_base(spark, sf_dir), TRANSACTION_EXPRS)


def gen1_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(*GEN1_CUSTOMER_COLUMNS)


def gen1_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions(spark, sf_dir)
    for old, new in GEN1_TRANSACTION_RENAMES.items():
        t = t.withColumnRenamed(old, new)
    return t.select(*GEN1_TRANSACTION_COLUMNS)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty customers with an ``ingest_seq`` giving the file order of duplicates."""
    base = _customer_base(spark, sf_dir)
    exprs = raw_customer_exprs("spark")
    first = _select(base, exprs).withColumn("ingest_seq", F.lit(0))
    dup = (_select(base.where(RAW_CUSTOMER_DUP_RULE), exprs)
           .withColumn("age", F.col("age") + 1).withColumn("ingest_seq", F.lit(1)))
    return first.unionByName(dup)


def _raw_transactions_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _transaction_base(spark, sf_dir)
    exprs = raw_transaction_exprs()
    exprs["l_partkey"] = "l_partkey"
    # the repeated rows come out of the same joins: a union would run these a second time
    seq = F.when(F.expr(RAW_TRANSACTION_DUP_RULE), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (_select(base, exprs).withColumn("ingest_seq", F.explode(seq))
            .withColumn("quantity", F.col("quantity") + F.col("ingest_seq")))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions (no customer filter) with ``ingest_seq``."""
    return _raw_transactions_keyed(spark, sf_dir).drop("l_partkey")


def raw_gen1_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _raw_transactions_keyed(spark, sf_dir)
    for col, e in RAW_GEN1_OVERRIDES.items():
        t = t.withColumn(col, F.expr(e))
    for old, new in GEN1_TRANSACTION_RENAMES.items():
        t = t.withColumnRenamed(old, new)
    return t.select(*GEN1_TRANSACTION_COLUMNS, "ingest_seq")


def raw_gen1_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_customers(spark, sf_dir).select(*GEN1_CUSTOMER_COLUMNS, "ingest_seq")
