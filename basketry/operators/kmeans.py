"""KMeans for many k and many starts in one pass a step, and a sampled Euclidean silhouette (M2-M4).

* *Lloyd steps.*  The centres of every (k, start) still moving are broadcast together: a few
  hundred short vectors.  One aggregation a step gives, for each centre, its rows, their sum and
  their squared distance; each task reads its rows once for all models, as matrix products
  over Arrow batches, and sends one row a centre.  Models that have settled drop out.
* *Seeds.*  k-means++ on at most ``SEED_ROWS`` rows, those with the smallest hash of their
  features, so a run does not depend on the order of rows; every start draws its own.
* *Silhouette.*  A customer's mean distance to a cluster is estimated from at most ``ANCHORS`` of its
  members (smallest hash again, dealt to ``FOLDS`` parts).  Every customer is compared with the anchors
  of every cluster; the parts' results give the standard error.  With clusters of at most
  ``ANCHORS`` customers the value is exact.

Bounds: seeds ``SEED_ROWS`` rows, anchors ``ANCHORS`` a cluster; every row counts in every step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED_ROWS, ANCHORS, FOLDS = 10_000, 200, 5
SLICE = 1024                    # rows whose distances are taken at once


@dataclass
class Run:
    """One (k, start): its centres, the sum of squared distances to them, and the steps it took."""

    k: int
    start: int
    centres: np.ndarray
    inertia: float = np.inf
    steps: int = 0
    settled: bool = False


def _matrix(column) -> np.ndarray:
    """Rows of a list column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ y.T + (y ** 2).sum(1)[None, :], 0)


def _step_rows(batches, centres, first):
    """(centre, n, sums, cost) of a task's rows; ``first`` cuts the stacked centres into models."""
    n, sums, cost = np.zeros(len(centres), np.int64), np.zeros_like(centres), np.zeros(len(centres))
    for batch in batches:
        rows = _matrix(batch.column("x"))
        for lo in range(0, len(rows), SLICE):               # distances that stay in a core's cache
            x = rows[lo:lo + SLICE]
            distance = _distances(x, centres)
            every = np.arange(len(x))
            for a, b in zip(first[:-1], first[1:], strict=True):
                own = np.argmin(distance[:, a:b], axis=1)
                member = np.zeros((b - a, len(x)))
                member[own, every] = 1.0
                n[a:b] += np.bincount(own, minlength=b - a)
                sums[a:b] += member @ x
                cost[a:b] += np.bincount(own, weights=distance[every, a + own], minlength=b - a)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.float64())), pa.array(cost)],
        names=["centre", "n", "sums", "cost"])


def _points(scaled: DataFrame) -> DataFrame:
    return scaled.select(vector_to_array("features").alias("x"))


def lloyd_step(points: DataFrame, runs: Sequence[Run], tolerance: float) -> None:
    """Move the centres of all ``runs`` once: one aggregation over the rows."""
    centres = np.vstack([r.centres for r in runs])
    first = np.cumsum([0] + [r.k for r in runs]).tolist()
    sent = points.mapInArrow(lambda it: _step_rows(it, centres, first), "centre int, n long, sums array<double>, cost double")
    width = centres.shape[1]
    got = sent.groupBy("centre").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                     F.array(*[F.sum(F.col("sums")[d]) for d in range(width)]).alias("sums")).collect()      # a row a centre
    n, sums, cost = np.zeros(len(centres)), np.zeros_like(centres), np.zeros(len(centres))
    for r in got:
        n[r.centre], sums[r.centre], cost[r.centre] = r.n, r.sums, r.cost
    for r, a, b in zip(runs, first[:-1], first[1:], strict=True):
        new = np.where(n[a:b, None] > 0, sums[a:b] / np.maximum(n[a:b, None], 1), r.centres)     # an empty cluster stays where it is
        r.inertia = float(cost[a:b].sum())
        r.settled = bool((((new - r.centres) ** 2).sum(1) <= tolerance ** 2).all())
        r.steps += 1
        if not r.settled:
            r.centres = new


def seeds(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample."""
    chosen = [sample[rng.integers(len(sample))]]
    near = _distances(sample, chosen[0][None, :])[:, 0]
    while len(chosen) < k:
        total = near.sum()
        at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
        chosen.append(sample[at])
        near = np.minimum(near, _distances(sample, chosen[-1][None, :])[:, 0])
    return np.array(chosen)


def fit_all(scaled: DataFrame, ks: Sequence[int], n_init: int = 10, max_iter: int = 300, seed: int = 42, tolerance: float = 1e-4,
            seed_rows: int = SEED_ROWS) -> list[Run]:
    """All runs of every k, each with its final centres and inertia."""
    points = _points(scaled)
    rows = points.orderBy(F.xxhash64("x"), "x").limit(seed_rows).collect()
    if not rows:
        raise ValueError("no rows to cluster")
    sample = np.array([r.x for r in rows])
    runs = [Run(k, i, seeds(sample, k, np.random.default_rng([seed, k, i]))) for k in ks for i in range(n_init)]
    for _ in range(max_iter):
        moving = [r for r in runs if not r.settled]
        if not moving:
            break
        lloyd_step(points, moving, tolerance)
    return runs


def best(runs: Sequence[Run], k: int) -> Run:
    """The run of lowest inertia (ties: the lower start)."""
    return min((r for r in runs if r.k == k), key=lambda r: (r.inertia, r.start))


def as_model(scaled: DataFrame, run: Run) -> KMeansModel:
    """The run as an MLlib model (transform, save and load as any other)."""
    spark = scaled.sparkSession
    jvm = spark._jvm
    centres = jvm.java.util.ArrayList()
    for c in run.centres.tolist():
        values = spark.sparkContext._gateway.new_array(jvm.double, len(c))
        for d, v in enumerate(c):
            values[d] = v
        centres.append(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
    plain = jvm.org.apache.spark.mllib.clustering.KMeansModel(centres)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{run.k}_{run.start}", plain))
    model._java_obj.set("k", run.k)
    return model.setFeaturesCol("features").setPredictionCol("cluster")


# ---------------------------------------------------------------- silhouette

def _anchor_rows(points: DataFrame, runs: Sequence[Run], anchors: int):
    """For each run a list of (centre, features) of the anchors: a row each, ``anchors`` a cluster at most."""
    centres = np.vstack([r.centres for r in runs])
    first = np.cumsum([0] + [r.k for r in runs]).tolist()

    def rows(batches):
        held = {}

        def trim(c, full):
            xs = np.vstack([x for x, _ in held[c]])
            hs = np.concatenate([h for _, h in held[c]])
            if len(hs) > (anchors if full else 4 * anchors):
                keep = np.argsort(hs, kind="stable")[:anchors]
                xs, hs = xs[keep], hs[keep]
            held[c] = [(xs, hs)]

        for batch in batches:
            x, h = _matrix(batch.column("x")), batch.column("h").to_numpy()
            distance = _distances(x, centres)
            for a, b in zip(first[:-1], first[1:], strict=True):
                own = np.argmin(distance[:, a:b], axis=1)
                for c in range(b - a):
                    mine = np.flatnonzero(own == c)
                    if len(mine):
                        held.setdefault(a + c, []).append((x[mine], h[mine]))
                        trim(a + c, False)
        for c in held:
            trim(c, True)
            xs, hs = held[c][0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hs), c, np.int32)), pa.array(hs), pa.array(xs.tolist(), pa.list_(pa.float64()))], names=["centre", "h", "x"])

    from pyspark.sql import Window
    sent = points.mapInArrow(rows, "centre int, h long, x array<double>")
    order = Window.partitionBy("centre").orderBy("h", "x")
    kept = sent.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= anchors).collect()
    out = [([], []) for _ in runs]
    of = np.repeat(np.arange(len(runs)), [r.k for r in runs])
    for r in sorted(kept, key=lambda r: (r.centre, r["rank"])):
        run = int(of[r.centre])
        out[run][0].append(r.centre - first[run])
        out[run][1].append(r.x)
    return [(np.array(c, np.int64), np.array(x)) for c, x in out]


def _silhouette_rows(batches, runs, anchors, folds):
    """(run, fold, n, sum) of a task's rows; fold -1 uses all anchors."""
    totals = np.zeros((len(runs), folds + 1, 2))
    for batch in batches:
        x = _matrix(batch.column("x"))
        for i, (run, (cluster, points)) in enumerate(zip(runs, anchors, strict=True)):
            own = np.argmin(_distances(x, run.centres), axis=1)
            distance = _distances(x, points)
            same = distance <= 1e-9 * (1 + (x ** 2).sum(1))[:, None]          # an anchor meets itself (or an equal row)
            distance = np.sqrt(np.where(same, 0.0, distance))
            fold = np.zeros(len(cluster), np.int64)
            for c in range(run.k):                      # anchors of a cluster are dealt out in turn
                mine = np.flatnonzero(cluster == c)
                fold[mine] = np.arange(len(mine)) % folds
            for f in range(-1, folds):
                use = np.ones(len(cluster), bool) if f < 0 else fold == f
                sums, count = np.zeros((len(x), run.k)), np.zeros(run.k)
                for c in range(run.k):
                    mine = use & (cluster == c)
                    sums[:, c], count[c] = distance[:, mine].sum(1), mine.sum()
                # an anchor's distance to itself is no distance to another customer
                rows = np.arange(len(x))
                self_hit = (same & use[None, :] & (cluster[None, :] == own[:, None])).any(1)
                size = count[own] - self_hit
                inner = np.where(size > 0, sums[rows, own] / np.maximum(size, 1), np.nan)
                outer = np.where(count > 0, sums / np.maximum(count, 1), np.inf)
                outer[rows, own] = np.inf
                nearest = outer.min(1)
                top = np.maximum(inner, nearest)
                s = np.where((size > 0) & np.isfinite(nearest) & (top > 0), (nearest - inner) / np.where(top > 0, top, 1), 0.0)
                totals[i, f + 1] += len(x), s.sum()
    flat = totals.reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["cell", "n", "s"])


def silhouettes(scaled: DataFrame, runs: Sequence[Run], anchors: int = ANCHORS, folds: int = FOLDS) -> list[tuple[float, float]]:
    """(mean Euclidean silhouette, its standard error) of each run: all runs in one pass."""
    points = _points(scaled).withColumn("h", F.xxhash64("x"))
    held = _anchor_rows(points, runs, anchors)
    models = list(runs)
    got = (points.select("x").mapInArrow(lambda it: _silhouette_rows(it, models, held, folds), "cell int, n double, s double")
           .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())                   # a row a run and fold
    mean = np.zeros(len(models) * (folds + 1))
    for r in got:
        mean[r.cell] = r.s / r.n if r.n else 0.0
    mean = mean.reshape(len(models), folds + 1)
    return [(float(m[0]), float(np.std(m[1:], ddof=1) / np.sqrt(folds))) for m in mean]
