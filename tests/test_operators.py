"""Layer 1/3: operator semantics against pandas on hand-made frames."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import clean, evaluate, features, ranking


def test_global_row_number_and_ntile_match_single_partition(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"id": [f"C{i:05d}" for i in range(1537)],
                        "x": rng.integers(0, 40, 1537)})        # many ties
    df = spark.createDataFrame(pdf).repartition(5)
    ours = ranking.global_ntile(df, [F.col("x").desc(), F.col("id")], 5, "nt")
    ours = ranking.global_row_number(ours, [F.col("x"), F.col("id")], out="rn")
    w = Window.orderBy(F.col("x").desc(), F.col("id"))
    ref = df.select("id", F.ntile(5).over(w).alias("nt_ref"),
                    F.row_number().over(Window.orderBy("x", "id")).alias("rn_ref"))
    j = ours.join(ref, "id")
    assert j.count() == 1537
    assert j.where((F.col("nt") != F.col("nt_ref")) | (F.col("rn") != F.col("rn_ref"))).count() == 0


def test_global_ntiles_one_sort_matches_windows(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": [f"C{i:05d}" for i in range(1203)],
                        "a": rng.integers(0, 30, 1203), "b": np.round(rng.random(1203) * 50, 2)})
    pdf.loc[::97, "a"] = None
    df = spark.createDataFrame(pdf).withColumn("b", F.col("b").cast("decimal(10,2)")) \
        .withColumn("a", F.col("a").cast("int"))
    ours = ranking.global_ntiles(df, "id", [("na", "a", True), ("nb", "b", False)], 5)
    ref = df.select("id", F.ntile(5).over(Window.orderBy(F.col("a").desc(), "id")).alias("ra"),
                    F.ntile(5).over(Window.orderBy("b", "id")).alias("rb"))
    j = ours.join(ref, "id")
    assert j.count() == 1203
    assert j.where((F.col("na") != F.col("ra")) | (F.col("nb") != F.col("rb"))).count() == 0


def test_qcut_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 500.0, 1001), 2)
    df = spark.createDataFrame(pd.DataFrame({"id": range(1001), "v": vals}))
    got = ranking.qcut_labels(df, "v", "lab").orderBy("id").toPandas()["lab"].tolist()
    want = pd.qcut(pd.Series(vals), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want
    got_r = ranking.qcut_labels(df, "v", "lab", descending=True).orderBy("id").toPandas()["lab"]
    want_r = pd.qcut(pd.Series(vals), 5, labels=[5, 4, 3, 2, 1]).astype(int)
    assert got_r.tolist() == want_r.tolist()


def test_qcut_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(i, 7.0) for i in range(20)], "id int, v double")
    with pytest.raises(ValueError):
        ranking.qcut_labels(df, "v", "lab")


def test_qcut_duplicate_edges_drop_matches_pandas(spark):
    vals = [1.0] * 8 + [2.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = ranking.qcut_labels(df, "v", "lab", duplicates="drop").orderBy("id").toPandas()["lab"]
    want = pd.qcut(pd.Series(vals), 5, labels=False, duplicates="drop") + 1
    assert got.tolist() == want.tolist()


def test_exact_quantiles_match_numpy(spark):
    vals = [5.0, 1.0, 3.5, 9.25, 2.0, 2.0, 8.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    row = ranking.exact_quantiles(df, "v", [0.0, 0.2, 0.5, 0.8, 1.0]).first()
    want = np.quantile(vals, [0.0, 0.2, 0.5, 0.8, 1.0])
    assert [row[f"q{i}"] for i in range(5)] == pytest.approx(list(want), abs=1e-12)


def test_average_rank_desc_matches_pandas(spark):
    vals = [10.0, 30.0, 30.0, 5.0, 20.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "c int, m double")
    got = ranking.average_rank_desc(df, "m", "r").orderBy("c").toPandas()["r"].tolist()
    assert got == pd.Series(vals).rank(ascending=False).astype(int).tolist()


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "k int, v int")
    got = ranking.prefix_sums(df, "k", ["v"], descending=True).orderBy(F.col("k").desc())
    vals = [r["cum_v"] for r in got.collect()]
    assert vals == list(np.cumsum([i % 3 for i in range(199, -1, -1)]))


def test_dedup_keeps_first_in_order(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 0, 20), ("b", 0, 5), (None, 0, 1), (None, 1, 2)],
                               "k string, ingest_seq int, v int")
    got = {(r.k, r.v) for r in clean.dedup_first(df, "k", ["ingest_seq"]).collect()}
    assert got == {("a", 20), ("b", 5), (None, 1)}


def test_rfm_base_pandas_null_semantics(spark):
    rows = [("t1", "c1", dt.date(2024, 12, 1), Decimal("10.00"), 2, 0),
            ("t2", "c1", dt.date(2024, 12, 20), Decimal("5.00"), 1, 0),
            ("t3", None, dt.date(2024, 12, 20), Decimal("5.00"), 1, 0),      # T1: dropped
            ("t4", "c2", dt.date(2024, 6, 1), None, 1, 0),                  # T2: sum -> 0
            ("t5", "c3", dt.date(2024, 6, 1), Decimal("7.00"), 1, 1)]       # returned
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, "
                                     "transaction_date date, final_amount decimal(15,2), "
                                     "quantity int, is_returned int")
    got = {r.customer_id: (r.recency, r.frequency, float(r.monetary))
           for r in features.rfm_base(df, "2025-01-01").collect()}
    assert got == {"c1": (12, 2, 25.0), "c2": (214, 1, 0.0)}


def test_auc_and_average_precision_match_rank_formulas(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 2)                                   # ties
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    auc = evaluate.roc_auc(df).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    u = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
    assert auc == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)
    ap = evaluate.average_precision(df).first()["average_precision"]
    order = np.argsort(-s, kind="stable")
    ys, ss = y[order], s[order]
    thresholds = np.unique(ss)[::-1]
    want, prev_r = 0.0, 0.0
    for t in thresholds:
        m = ss >= t
        tp = ys[m].sum()
        r, p = tp / y.sum(), tp / m.sum()
        want += (r - prev_r) * p
        prev_r = r
    assert ap == pytest.approx(want, abs=1e-9)


def test_auc_equals_spark_evaluator_without_binning(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"label": rng.integers(0, 2, 300).astype(float),
                                             "score": rng.random(300)}))
    ours = evaluate.roc_auc(df).first()["auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                           numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_classification_report_and_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)],
                               "label int, prediction int")
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert rep["1"]["precision"] == pytest.approx(2 / 3) and rep["1"]["recall"] == pytest.approx(2 / 3)
    assert rep["accuracy"]["precision"] == pytest.approx(4 / 6) and rep["macro avg"]["support"] == 6
    cm = {r.actual: (r.predicted_0, r.predicted_1) for r in evaluate.confusion_matrix(df).collect()}
    assert cm == {0: (2, 1), 1: (1, 2)}


@pytest.mark.parametrize("n", [1, 3, 5, 7, 50])
def test_first_n_cutoff_equals_plain_limit(spark, n):
    from basketry.sources.writers import first_n
    rows = [("t1", None), ("t2", dt.date(2024, 1, 2)), ("t3", dt.date(2024, 1, 1)),
            ("t4", dt.date(2024, 1, 2)), ("t5", dt.date(2024, 1, 2)), ("t6", None),
            ("t7", dt.date(2024, 1, 3))]
    df = spark.createDataFrame(rows, "transaction_id string, transaction_date date")
    want = [r.transaction_id for r in df.orderBy("transaction_date", "transaction_id").limit(n).collect()]
    got = [r.transaction_id for r in first_n(df, n).collect()]
    assert got == want


def test_hot_value_is_split_across_range_partitions(spark):
    """A value held by a third of all rows still spreads over the range
    partitions because the sort key ends with the id (the ranking design)."""
    n = 6000
    rows = [(f"C{i:05d}", 7 if i % 3 == 0 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, x long")
    by_key = df.repartitionByRange(8, "x", "id").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in by_key.collect()]
    assert max(sizes) <= 2 * n / 8                     # balanced with the id tiebreak
    by_value = df.repartitionByRange(8, "x").groupBy(F.spark_partition_id().alias("p")).count()
    assert max(r["count"] for r in by_value.collect()) >= n / 3   # the skew it avoids
    ranked = ranking.global_row_number(df, [F.col("x"), F.col("id")], out="rn")
    assert ranked.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, n, n)
