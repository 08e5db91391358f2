"""Customer segmentation with MLlib (survey M1-M9).

Differences to the scikit-learn reference that are inherent, not bugs:

* ``StandardScaler`` divides by the sample standard deviation (sklearn: the
  population one).  Every feature is scaled by the same factor
  sqrt(n / (n - 1)), so cluster assignments are unchanged; inertia is not.
* Every k and all ``n_init`` starts run together (``kmeans.fit_all``): one aggregation a
  step for all of them; the lowest inertia wins.
* The silhouette is the Euclidean one, every customer against a bounded sample of each
  cluster, with a standard error (``kmeans.silhouettes``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators import frames, kmeans, ranking
from basketry.session import ensure_checkpoint_dir

# Feature lists and segment names of the reference.
SEGMENT_FEATURES = ["recency", "frequency", "monetary", "age", "loyalty_points", "tenure_days"]
GEN1_FEATURES = ["recency", "frequency", "monetary"]
SWEEP_ITERATIONS = 300      # of the k sweep; the final fit takes up to 500
CLUSTER_LABELS = ["High-Value Champions", "Loyal Mid-Tier", "Price-Sensitive Bargain Hunters",
                  "Dormant / At-Risk"]


def prepare_features(customer_360: DataFrame, features=SEGMENT_FEATURES,
                     id_col: str = "customer_id") -> tuple[DataFrame, PipelineModel]:
    """M1: drop rows with a NULL feature, assemble, standardise (mean 0, sd 1).

    The features are written to the checkpoint folder and spread over the tasks before anything is
    fitted, then the standardised frame (every step reads it again); nothing stays cached.
    """
    data = customer_360.select(id_col, *[F.col(c).cast("double").alias(c) for c in features]) \
        .dropna(subset=list(features))
    ensure_checkpoint_dir(data.sparkSession)
    data = frames.spread(data.checkpoint(eager=True))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)])
    model = pipe.fit(data)
    return model.transform(data).drop("raw_features").checkpoint(eager=True), model


def fit_kmeans(scaled: DataFrame, k: int, n_init: int = 10, max_iter: int = 500, seed: int = 42) -> KMeansModel:
    """M2: best of ``n_init`` k-means++ starts by inertia, all starts in one pass a step."""
    return kmeans.as_model(scaled, kmeans.best(kmeans.fit_all(scaled, [k], n_init, max_iter, seed), k))


def k_sweep(scaled: DataFrame, ks=range(2, 9), n_init: int = 10, max_iter: int = SWEEP_ITERATIONS,
            seed: int = 42) -> DataFrame:
    """M3 + M4: (k, inertia, silhouette, silhouette_error) for every k; ``best_k`` picks the max silhouette."""
    runs = kmeans.fit_all(scaled, list(ks), n_init, max_iter, seed)
    chosen = [kmeans.best(runs, k) for k in ks]
    rows = [(int(r.k), r.inertia, s, e) for r, (s, e) in zip(chosen, kmeans.silhouettes(scaled, chosen), strict=True)]
    return scaled.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, silhouette_error double")


def best_k(sweep: DataFrame) -> int:
    """Arg-max silhouette (ties: the smaller k, like ``np.argmax``); one-row aggregate."""
    return sweep.agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("k")) \
        .first()["k"]


def label_clusters(assigned: DataFrame, labels=CLUSTER_LABELS) -> DataFrame:
    """M5: name clusters by the rank of their mean monetary value (descending,
    average ties truncated); ranks beyond the list take the last name."""
    means = assigned.groupBy("cluster").agg(F.avg("monetary").alias("_m"))
    ranked = ranking.average_rank_desc(means, "_m", "_rank")
    names = F.array(*[F.lit(x) for x in labels])
    mapping = ranked.select("cluster", F.element_at(names, F.least(F.col("_rank"), F.lit(len(labels))))
                            .alias("segment_label"))
    # k rows: bounded by the number of clusters.
    return assigned.join(F.broadcast(mapping), "cluster", "left")


def label_clusters_gen1(assigned: DataFrame) -> DataFrame:
    """M6: highest mean monetary -> 'Champions', lowest mean recency -> 'At Risk'
    (applied second, so it wins when both hit one cluster), others 'Regular'."""
    means = assigned.groupBy("cluster").agg(F.avg("monetary").alias("_m"), F.avg("recency").alias("_r"))
    allk = Window.partitionBy()  # k rows
    mapping = means.select(
        "cluster", F.max_by("cluster", "_m").over(allk).alias("_champ"),
        F.min_by("cluster", "_r").over(allk).alias("_risk")).select(
        "cluster",
        F.when(F.col("cluster") == F.col("_risk"), "At Risk")
        .when(F.col("cluster") == F.col("_champ"), "Champions").otherwise("Regular")
        .alias("segment_label"))
    return assigned.join(F.broadcast(mapping), "cluster", "left")


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """M7: customers and rounded means per (cluster, label)."""
    return labelled.groupBy("cluster", "segment_label").agg(
        F.count("customer_id").alias("customer_count"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(F.avg("recency"), 2).alias("avg_recency"),
        F.round(F.avg("loyalty_points"), 2).alias("avg_loyalty"))


def cluster_profile(labelled: DataFrame, features=SEGMENT_FEATURES) -> DataFrame:
    """M8 + P22: feature means per cluster and their min-max normalised value."""
    prof = labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])
    allk = Window.partitionBy()  # k rows
    out = prof
    for c in features:
        lo, hi = F.min(c).over(allk), F.max(c).over(allk)
        out = out.withColumn(f"{c}_norm", (F.col(c) - lo) / (hi - lo + F.lit(1e-9)))
    return out


def pca_projection(assigned: DataFrame, k: int = 2) -> tuple[DataFrame, list[float]]:
    """M9: 2-D projection of the standardised features + explained variance ratio."""
    model = PCA(k=k, inputCol="features", outputCol="_pcs").fit(assigned)
    arr = vector_to_array("_pcs")
    out = model.transform(assigned).select(
        "customer_id", "cluster", *[arr[i].alias(f"pc{i + 1}") for i in range(k)])
    return out, [float(v) for v in model.explainedVariance]


def run_segmentation(customer_360: DataFrame, ks=range(2, 9), n_init: int = 10,
                     max_iter: int = 500, seed: int = 42):
    """Features -> sweep -> final fit -> labels (+ summary, PCA, profile)."""
    scaled, scaler = prepare_features(customer_360)
    sweep = k_sweep(scaled, ks, n_init=n_init, max_iter=min(max_iter, SWEEP_ITERATIONS), seed=seed)
    k = best_k(sweep)
    model = fit_kmeans(scaled, k, n_init=n_init, max_iter=max_iter, seed=seed)
    assigned = model.transform(scaled)
    labelled = label_clusters(assigned)
    return {"scaled": scaled, "scaler": scaler, "sweep": sweep, "k": k, "model": model,
            "segments": labelled.drop("features"), "assigned": assigned,
            "summary": cluster_summary(labelled), "profile": cluster_profile(labelled)}


def segment_gen1(rfm: DataFrame, k: int = 4, n_init: int = 10, seed: int = 42) -> DataFrame:
    """E9 segmentation: 3 RFM features, k = 4, gen-1 naming."""
    scaled, _ = prepare_features(rfm, GEN1_FEATURES)
    model = fit_kmeans(scaled, k, n_init=n_init, max_iter=300, seed=seed)
    labelled = label_clusters_gen1(model.transform(scaled))
    return labelled.drop("features")
