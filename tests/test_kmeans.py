"""All starts together against plain Lloyd runs; the sampled silhouette against all pairs."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from basketry.operators import kmeans, segment
from basketry.plans.registry import queries


def points(n=600, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 4, (4, 3))
    return centres[rng.integers(0, 4, n)] + rng.normal(0, 1, (n, 3))


@pytest.fixture(scope="module")
def scaled(spark):
    x = points()
    return spark.createDataFrame([(f"C{i}", Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["customer_id", "features"]).repartition(5)


def plain_lloyd(x, centres, max_iter, tolerance):
    inertia = None
    for _ in range(max_iter):
        d = ((x[:, None, :] - centres[None]) ** 2).sum(2)
        own = d.argmin(1)
        inertia = d[np.arange(len(x)), own].sum()
        new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        if (((new - centres) ** 2).sum(1) <= tolerance ** 2).all():
            break
        centres = new
    return inertia, centres


def test_every_start_equals_a_plain_run(scaled):
    x = points()
    runs = kmeans.fit_all(scaled, [2, 4, 5], n_init=3, max_iter=50, seed=7)
    assert [(r.k, r.start) for r in runs] == [(k, i) for k in (2, 4, 5) for i in range(3)]
    rows = scaled.select(F.col("features")).collect()
    order = {tuple(r.features.toArray()): 0 for r in rows}
    assert len(order) == len(x)
    from pyspark.ml.functions import vector_to_array
    sample = np.array([r.x for r in scaled.select(vector_to_array("features").alias("x")).orderBy(F.xxhash64("x"), "x").collect()])
    for r in runs:
        inertia, centres = plain_lloyd(x, kmeans.seeds(sample, r.k, np.random.default_rng([7, r.k, r.start])), 50, 1e-4)
        assert r.inertia == pytest.approx(inertia, rel=1e-9) and np.allclose(r.centres, centres)
    assert kmeans.best(runs, 4).inertia == min(r.inertia for r in runs if r.k == 4)
    assert kmeans.best(runs, 2).inertia > kmeans.best(runs, 4).inertia


def test_one_pass_a_step_whatever_the_starts(scaled, monkeypatch):
    seen = []
    real = kmeans.lloyd_step
    monkeypatch.setattr(kmeans, "lloyd_step", lambda p, runs, t: (seen.append(len(runs)), real(p, runs, t)))
    runs = kmeans.fit_all(scaled, [3, 4], n_init=5, max_iter=60)
    assert seen[0] == 10 and seen == sorted(seen, reverse=True) and len(seen) == max(r.steps for r in runs)
    assert all(r.settled for r in runs)


def test_model_assigns_saves_and_loads(scaled, tmp_path):
    run = kmeans.best(kmeans.fit_all(scaled, [4], n_init=2), 4)
    model = kmeans.as_model(scaled, run)
    out = model.transform(scaled).select("features", "cluster").collect()
    for r in out:
        assert r.cluster == int(((run.centres - r.features.toArray()) ** 2).sum(1).argmin())
    model.write().overwrite().save(str(tmp_path / "m"))
    again = KMeansModel.load(str(tmp_path / "m"))
    assert np.allclose(again.clusterCenters(), run.centres) and again.getK() == 4


def full_silhouette(x, own):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, own == c].mean() for c in set(own.tolist()) - {own[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_is_within_its_error(scaled):
    x = points()
    runs = [kmeans.best(kmeans.fit_all(scaled, [k], n_init=2), k) for k in (2, 4)]
    exact = [full_silhouette(x, ((x[:, None, :] - r.centres[None]) ** 2).sum(2).argmin(1)) for r in runs]
    whole = kmeans.silhouettes(scaled, runs, anchors=1000)
    assert [s for s, _ in whole] == pytest.approx(exact, abs=1e-9)          # every customer is an anchor
    for (s, error), want in zip(kmeans.silhouettes(scaled, runs, anchors=60), exact, strict=True):
        assert 0 < error < 0.05 and abs(s - want) < max(4 * error, 0.02)


def test_empty_and_equal_rows(spark):
    same = spark.createDataFrame([("a", Vectors.dense([1.0, 1.0]))] * 20, ["customer_id", "features"])
    run, = kmeans.fit_all(same, [3], n_init=1)
    assert run.inertia == pytest.approx(0) and run.settled
    with pytest.raises(ValueError, match="no rows"):
        kmeans.fit_all(same.where("customer_id = 'b'"), [2])


def test_sweep_keeps_nothing_cached_and_inertia_falls(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    rows = sorted(queries()["kmeans_k_sweep"](spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.k)
    inertia = [r.inertia for r in rows]
    assert inertia == sorted(inertia, reverse=True) and all(-1 <= r.silhouette <= 1 for r in rows)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
