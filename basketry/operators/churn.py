"""Churn prediction with MLlib (survey M10-M16, M22).

Class balancing (sklearn ``class_weight="balanced"``) becomes a weight
column n / (2 n_class); the logistic regression gets sklearn's C = 1 as
``regParam = 1 / sum(weights)`` on features standardised beforehand.
Model selection, evaluation and scoring are all DataFrame jobs; nothing is
collected except the metric rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions import exprs as X
from basketry.operators import evaluate, frames, selection
from basketry.session import ensure_checkpoint_dir

# Feature list and NULL fills of the reference.
CHURN_FEATURES = ["age", "loyalty_points", "tenure_days", "recency", "frequency", "monetary",
                  "rfm_score", "gender_enc", "region_enc", "segment_enc"]
ATTRIBUTES = ["segment", "region", "is_churned"]
CATEGORY_FILLS = {"gender": "Unknown", "region": "Unknown", "segment": "Regular"}


def engineer_features(customer_360: DataFrame, label: str = "is_churned") -> DataFrame:
    """NULL fills, label-encode gender/region/segment alphabetically, drop
    incomplete rows.  Returns id, the 10 features, ``label`` and the customer's own
    segment, region and is_churned, which the score table shows (M22)."""
    shown = [F.col(c).alias(f"_{c}") for c in ATTRIBUTES]
    df = customer_360.select("*", *shown).fillna(CATEGORY_FILLS)
    names = list(CATEGORY_FILLS)
    # one pass over the table for all three encodings
    df = StringIndexer(inputCols=names, outputCols=[f"{c}_enc" for c in names],
                       stringOrderType="alphabetAsc").fit(df).transform(df)
    cols = [F.col(c).cast("double").alias(c) for c in CHURN_FEATURES]
    return df.select("customer_id", *cols, F.col(label).cast("int").alias("label"),
                     *[F.col(f"_{c}").alias(c) for c in ATTRIBUTES]) \
        .dropna(subset=CHURN_FEATURES + ["label"])


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "customer_id",
                     test_fraction=(1, 5), seed: int = 42) -> DataFrame:
    """Exact stratified split, adds ``split`` ('train' / 'test').

    Within each class rows are ordered by md5(id:seed); the first
    ceil(n_class * a / b) are the test set.  The last of them is selected exactly as a cut
    key, so rows are only compared with it: nothing is sorted, joined or written.
    Class sizes are one row per label value; a NULL label is a class too.
    """
    a, b = test_fraction
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    is_test = F.lit(False)
    for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect():
        own = F.col(label).eqNullSafe(F.lit(r[label]))
        order = selection.Dimension(F.when(own, h), nulls_first=False)
        (cut,), = selection.cut_keys(df, id_col, [order], lambda _, n=r["n"]: [-(-n * a // b)])
        is_test = is_test | (own & (selection.buckets_from_cuts(df, id_col, order, [cut]) == 1))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def balanced_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """n / (n_classes * n_class) per row (class count table: one row per class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = Window.partitionBy()
    counts = counts.select(label, (F.sum("_nc").over(tot) / (F.count(F.lit(1)).over(tot) * F.col("_nc")))
                           .alias("weight"))
    return train.join(F.broadcast(counts), label)


def model_pipelines(weight_sum: float, features=CHURN_FEATURES, seed: int = 42) -> dict:
    """M13-M15 with the reference's hyper-parameters."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return {
        "Logistic Regression": Pipeline(stages=[assembler, scaler, LogisticRegression(
            featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=500,
            regParam=1.0 / weight_sum, elasticNetParam=0.0, standardization=False)]),
        "Random Forest": Pipeline(stages=[assembler, RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", numTrees=150,
            maxDepth=8, featureSubsetStrategy="sqrt", seed=seed)]),
        "Gradient Boosting": Pipeline(stages=[assembler, GBTClassifier(
            featuresCol="features", labelCol="label", maxIter=100, maxDepth=4, stepSize=0.1,
            seed=seed)]),
    }


def with_scores(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("score", vector_to_array("probability")[1]) \
        .withColumn("prediction", F.col("prediction").cast("int"))


def train_models(split: DataFrame, features=CHURN_FEATURES, seed: int = 42):
    """Fit all models on 'train', evaluate on 'test', pick the best AUC.

    Returns (metrics DataFrame, fitted models, best model name, test predictions).
    """
    # written once: every iteration of every model reads them again
    train = balanced_weights(split.where(F.col("split") == "train")).checkpoint(eager=True)
    test = split.where(F.col("split") == "test").checkpoint(eager=True)
    weight_sum = train.agg(F.sum("weight")).first()[0]
    pipes = model_pipelines(weight_sum, features, seed)

    def fit_and_score(name):
        model = pipes[name].fit(train)
        pred = with_scores(model.transform(test))
        auc, ap = evaluate.ranking_metrics(pred).first()
        f1 = evaluate.classification_report(pred).where(F.col("class") == "1").first()["f1_score"]
        return name, model, pred, (name, float(auc), float(ap), float(f1))

    # The three fits are independent Spark jobs; run them concurrently.
    with ThreadPoolExecutor(max_workers=len(pipes)) as pool:
        results = list(pool.map(fit_and_score, list(pipes)))
    fitted = {name: model for name, model, _, _ in results}
    predictions = {name: pred for name, _, pred, _ in results}
    rows = [row for _, _, _, row in results]
    metrics = split.sparkSession.createDataFrame(
        rows, "model string, auc double, average_precision double, f1_churn double")
    best = max(rows, key=lambda r: r[1])[0]
    return metrics, fitted, best, predictions


def feature_importance(model: PipelineModel, features=CHURN_FEATURES) -> DataFrame:
    """M10 + O6: importances of the forest stage, sorted descending."""
    stage = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(features, stage.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.col("importance").desc(), F.col("feature"))


def score_customers(model: PipelineModel, featured: DataFrame) -> DataFrame:
    """Score every customer (not only the test set), round 4, risk bins."""
    return risk_scores(with_scores(model.transform(featured)))


def risk_scores(scored: DataFrame) -> DataFrame:
    """The score table of rows with ``score`` and the customer's attributes."""
    return scored.select("customer_id", *ATTRIBUTES,
                         F.bround(F.col("score"), 4).alias("churn_probability")) \
        .withColumn("churn_risk", X.churn_risk_bin("churn_probability"))


def run_churn_model(customer_360: DataFrame, seed: int = 42):
    """E5: features -> split -> train/evaluate -> score all -> best model."""
    ensure_checkpoint_dir(customer_360.sparkSession)
    featured = frames.spread(engineer_features(customer_360.checkpoint(eager=True)).checkpoint(eager=True))
    split = stratified_split(featured, seed=seed)
    metrics, fitted, best, preds = train_models(split, seed=seed)
    scores = score_customers(fitted[best], featured)
    return {"metrics": metrics, "models": fitted, "best": best, "scores": scores,
            "importance": feature_importance(fitted["Random Forest"]), "split": split,
            # M20 / M21 per model on the test split (the reference's plots).
            "confusion": {n: evaluate.confusion_matrix(p) for n, p in preds.items()},
            "roc": {n: evaluate.roc_points(p) for n, p in preds.items()}}


def churn_gen1(rfm: DataFrame, seed: int = 42):
    """E9 churn: label recency > 180, RFM features, 100 trees.

    The reference grows its trees without a depth limit; Spark's limit is 30.
    """
    feats = ["recency", "frequency", "monetary"]
    df = rfm.select("customer_id", *[F.col(c).cast("double").alias(c) for c in feats],
                    X.recency_churn_label("recency").alias("label")).dropna()
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)         # split, fit and scores read the very same rows
    split = stratified_split(df, seed=seed)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            RandomForestClassifier(featuresCol="features", labelCol="label",
                                                   numTrees=100, maxDepth=30, seed=seed)])
    model = pipe.fit(train)
    report = evaluate.classification_report(with_scores(model.transform(test)))
    scores = with_scores(model.transform(df)).select(
        "customer_id", "recency", "frequency", "monetary", "label",
        F.col("score").alias("churn_probability"))
    return {"model": model, "report": report, "scores": scores,
            "importance": feature_importance(model, feats)}
