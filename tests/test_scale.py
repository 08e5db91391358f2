"""Rows out of joins are cleaned in one pass, with the columns that are wanted; model tables are spread over the tasks."""


from basketry.operators import clean, quality
from basketry.sources import tables as T

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def struct_of(df):
    return next(line for line in plan(df).splitlines() if "min(struct(" in line).split("AS _first")[0]


# ------------------------------------------------------------ clean_transactions
def test_transactions_are_joined_once(spark):
    p = plan(clean.clean_transactions(T.raw_transactions(spark, SF)))
    assert p.count("l_orderkey") and p.count("Join") == 2 and "Union" not in p


def test_repeated_raw_rows_follow_the_rule(spark):
    rows = T.raw_transactions(spark, SF).collect()
    first, again = ([(r.transaction_id, r.quantity - r.ingest_seq) for r in rows if r.ingest_seq == k] for k in (0, 1))
    assert sorted(again) == sorted(x for x in first if x[0].endswith("7")) != [] and len(rows) == len(first) + len(again)


# ------------------------------------------------------------ orphans, quality_report: wanted columns only
def test_wanted_columns_keep_the_same_rows(spark):
    rows = [("a", "C1", "x", 1, 5), ("a", "C0", "y", 1, 4), ("a", "C0", "x", 0, 9), ("b", "C2", "z", 0, 1), ("b", "C2", "y", 0, 1), (None, "C3", "x", 2, 1), (None, None, "x", 1, 1)]
    df = spark.createDataFrame(rows, "k string, customer_id string, category string, ingest_seq int, v int")
    whole = clean.dedup_first(df, "k", ["ingest_seq"], 0)
    for columns in (["k", "customer_id"], ["k", "category"], ["k"]):
        some = clean.dedup_first(df, "k", ["ingest_seq"], 0, columns)
        assert sorted(some.select(*columns).collect(), key=str) == sorted(whole.select(*columns).collect(), key=str)
    assert "category" not in struct_of(clean.dedup_first(df, "k", ["ingest_seq"], 0, ["k", "customer_id"]))


def test_orphans_carry_ids_only(spark):
    raw = T.raw_transactions(spark, SF)
    ids = clean.clean_transactions(raw, columns=["transaction_id", "customer_id"])
    assert "customer_id" in struct_of(ids) and "transaction_date" not in plan(ids) and "p_type" not in plan(ids).split("Relation")[0]
    customers = T.raw_customers(spark, SF)
    whole = quality.orphan_transactions(clean.clean_transactions(raw), customers).select("transaction_id", "customer_id")
    some = quality.orphan_transactions(ids, customers, keys_from=raw).select("transaction_id", "customer_id")
    assert sorted(some.collect(), key=str) == sorted(whole.collect(), key=str) != []


def test_quality_report_leaves_out_what_no_rule_reads(spark):
    raw = T.raw_transactions(spark, SF)
    some = clean.clean_transactions(raw, columns=quality.TRANSACTION_RULE_COLUMNS)
    assert some.columns == quality.TRANSACTION_RULE_COLUMNS and "payment_method" not in struct_of(some)
    whole = clean.clean_transactions(raw).select(*quality.TRANSACTION_RULE_COLUMNS)
    assert sorted(some.collect(), key=str) == sorted(whole.collect(), key=str)


# ------------------------------------------------------------ clean_gen1
def test_gen1_transactions_are_not_counted_first(spark, monkeypatch):
    seen = []
    frame = type(spark.range(1))
    real = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **b: (seen.append(self.columns), real(self, *a, **b))[1])
    clean.clean_gen1(T.raw_gen1_customers(spark, SF), T.raw_gen1_transactions(spark, SF))
    assert sum("transaction_id" in c for c in seen) == 1 and sum(c == ["_again0"] for c in seen) <= 1      # the customers' keys


# ------------------------------------------------------------ tables of the models
def test_model_tables_are_spread_by_their_rows(spark):
    from basketry.operators import frames
    df = spark.range(4000).coalesce(1)
    assert frames.spread(df, 500).rdd.getNumPartitions() == 8 and frames.spread(df, 500).count() == 4000
    assert frames.spread(df, 5000).rdd.getNumPartitions() == 1              # small tables stay as they are
