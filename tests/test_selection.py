"""Order statistics, cut keys and prefix sums against plain sorts, small limits included."""

import random
import re
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.operators import ranking, selection
from tests.plan_shapes import exchanges


def rows_of(seed, n, hot):
    """(id, double, decimal, long, string): ``hot`` holds a third of the rows, some are null."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = rng.choice([rng.gauss(0, 50), hot, hot, float(rng.randint(0, 9)), None]) if rng.random() < 0.9 else rng.lognormvariate(3, 4)
        d = None if x is None else Decimal(str(round(x, 2)))
        out.append((i, x, d, rng.choice([2 ** 60 + rng.randint(0, 4), rng.randint(-5, 5), None]), rng.choice(["", "a", "ab", f"CUST{rng.randint(0, 400):07d}", "é", None])))
    rng.shuffle(out)
    return out


SCHEMA = "id long, x double, d decimal(18,2), k long, s string"


@pytest.mark.parametrize("n,limit", [(2000, 10 ** 6), (600, 50), (150, 1), (7, 2)])
def test_order_statistics_equal_a_sort(spark, n, limit):
    rows = rows_of(n + limit, n, 7.25)
    df = spark.createDataFrame(rows, SCHEMA)
    wanted, expected = [], []
    for at, name in enumerate(("x", "d", "k", "s"), start=1):
        values = sorted((r[at] for r in rows if r[at] is not None), key=lambda v: v.encode() if isinstance(v, str) else v)
        for r in sorted({1, 2, n // 3, n // 2, len(values) - 1, len(values), len(values) + 1} if limit > 50 else {n // 3, len(values), len(values) + 1}):
            wanted.append((F.col(name), r))
            expected.append(None if not 1 <= r <= len(values) else
                            selection.Picked(values[r - 1], sum(v < values[r - 1] for v in values) if name != "s" else sum(v.encode() < values[r - 1].encode() for v in values),
                                             values.count(values[r - 1])))
    assert selection.order_statistics(df, wanted, limit) == expected


def test_brackets_that_do_not_narrow_are_sorted(spark, monkeypatch):
    """Neighbouring longs beyond 2**53 look alike to the sketch."""
    df = spark.createDataFrame([(2 ** 60 + i % 40,) for i in range(2000)], "k long")
    got = selection.order_statistics(df, [(F.col("k"), r) for r in (1, 777, 2000)], limit=10)
    assert got == [selection.Picked(2 ** 60 + (r - 1) // 50, (r - 1) // 50 * 50, 50) for r in (1, 777, 2000)]


@pytest.mark.parametrize("limit", [10 ** 6, 20])
def test_quantiles_equal_pandas(spark, limit):
    rows = rows_of(5, 1500, 1.5)
    got = selection.quantiles(spark.createDataFrame(rows, SCHEMA), ["x", "k"], [0, 0.1, 0.5, 1 / 3, 0.99, 1], limit)
    for at, name in ((1, "x"), (3, "k")):
        want = pd.Series([r[at] for r in rows if r[at] is not None], dtype=float).quantile([0, 0.1, 0.5, 1 / 3, 0.99, 1]).tolist()
        assert got[name] == pytest.approx(want, rel=1e-12)
    assert selection.quantiles(spark.createDataFrame([(1, None, None, None, None)], SCHEMA), ["x"], [0.5]) == {}


@pytest.mark.parametrize("ids", ["id", "name"])
@pytest.mark.parametrize("n,limit", [(900, 10 ** 6), (900, 8), (3, 5), (0, 5)])
def test_ntiles_by_cut_keys_equal_the_window(spark, n, limit, ids):
    rows = [(i if i != 5 else None, f"CUST{i:07d}" if i != 5 else None, d, k) for i, _, d, k, _ in rows_of(9, n, 3.0)]
    df = spark.createDataFrame(rows, "id long, name string, d decimal(18,2), k long")
    got = ranking.global_ntiles(df, ids, [("up", "d", False), ("down", "d", True), ("k5", "k", False)], 5, limit)
    df.createOrReplaceTempView("plain_ntiles")
    want = spark.sql(f"""SELECT *, ntile(5) OVER (ORDER BY d, {ids}) AS up, ntile(5) OVER (ORDER BY d DESC, {ids}) AS down,
                         ntile(5) OVER (ORDER BY k, {ids}) AS k5 FROM plain_ntiles""")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # buckets are comparisons: nothing is exchanged once the cuts are known
    assert exchanges(got) == []


@pytest.mark.parametrize("buckets,descending", [(256, True), (256, False), (4, True), (2, False)])
def test_prefix_sums_equal_a_running_sum(spark, buckets, descending):
    rng = random.Random(buckets)
    rows = [(x, rng.randint(0, 9), rng.choice([None, 1, 5])) for x in {round(rng.gauss(0, 1), 3) for _ in range(3000)}]
    df = spark.createDataFrame(rows, "x double, a long, b int").repartition(6)
    got = ranking.prefix_sums(df, "x", ["a", "b"], descending, buckets, with_totals=True)
    frame = pd.DataFrame(rows, columns=["x", "a", "b"]).sort_values("x", ascending=not descending).reset_index(drop=True)
    own = got.toPandas().sort_values("x", ascending=not descending).reset_index(drop=True)
    assert np.array_equal(own["cum_a"], frame["a"].cumsum())
    assert np.array_equal(own["cum_b"], frame["b"].fillna(0).cumsum())
    assert set(own["total_a"]) == {frame["a"].sum()} and set(own["total_b"]) == {int(frame["b"].sum())}
    # one exchange, by range
    found = exchanges(got)
    assert len(found) == 1 and "_range" in found[0][0]


def test_prefix_sums_of_nothing(spark):
    assert ranking.prefix_sums(spark.createDataFrame([], "x double, a long"), "x", ["a"], with_totals=True).count() == 0


def test_selection_exchanges_summaries_only(spark):
    """No plan of the selection carries rows: sketches, counts and one narrow band."""
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("x"))
    seen = []
    real = type(df).agg

    def agg(self, *a):
        out = real(self, *a)
        seen.append(max([r for _, r in exchanges(out)], default=0))
        return out

    type(df).agg = agg
    try:
        got = selection.quantiles(df, ["x"], [0.5], limit=500)
    finally:
        type(df).agg = real
    assert max(seen) <= 64
    assert got["x"][0] == df.toPandas()["x"].median()
