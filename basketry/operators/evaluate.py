"""Model evaluation as Spark jobs (survey M4, M17-M21).

Threshold metrics are computed from per-score counts: ``groupBy(score)``
gives (positives, negatives) per distinct score, and two levels of sums
(``ranking.prefix_sums``: over ranges of scores, then inside each) give the
cumulative counts -- no single-partition window, no sort of all scores.

* ROC-AUC is the exact Mann-Whitney form (ties count one half), as an exact
  integer numerator over 2 P N.  ``BinaryClassificationEvaluator`` with its
  default 1000 bins would be an approximation.
* Average precision is the step sum of scikit-learn,
  sum (R_k - R_k-1) P_k, not the interpolated ``areaUnderPR``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import ranking
from basketry.operators.frames import combine_rows


def score_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score with its positives (tp) and negatives (fp),
    the running counts over scores >= it, and the totals P (total_tp) and
    N (total_fp)."""
    per = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) != 1).alias("fp"))
    return ranking.prefix_sums(per, score, ["tp", "fp"], descending=True, with_totals=True)


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """M17 and M18 from one count per score: one row, ``auc`` and ``average_precision``."""
    c = score_counts(scored, label, score)
    return combine_rows(_auc(c), _average_precision(c, 10))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row, ``auc``."""
    return _auc(score_counts(scored, label, score))


def _auc(c: DataFrame) -> DataFrame:
    # fp_s * (2 * TP strictly above s + tp_s), exact integers.
    term = F.col("fp").cast("decimal(38,0)") * (2 * (F.col("cum_tp") - F.col("tp")) + F.col("tp"))
    agg = c.agg(F.sum(term).alias("_num"), F.sum("tp").alias("_P"), F.sum("fp").alias("_N"))
    den = F.col("_P").cast("double") * F.col("_N").cast("double") * 2.0
    return agg.select(F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                             F.col("_num").cast("double") / den).alias("auc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score",
                      digits: int = 10) -> DataFrame:
    """One row, ``average_precision`` (rounded to ``digits`` so that the float
    summation order of a distributed sum does not show)."""
    return _average_precision(score_counts(scored, label, score), digits)


def _average_precision(c: DataFrame, digits: int) -> DataFrame:
    precision = F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp")).cast("double")
    agg = c.agg(F.sum(F.col("tp").cast("double") * precision).alias("_s"), F.sum("tp").alias("_P"))
    return agg.select(F.when(F.col("_P") > 0, F.round(F.col("_s") / F.col("_P").cast("double"),
                                                        digits)).alias("average_precision"))


def roc_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score (threshold), fpr and tpr of ``score >= threshold``."""
    c = score_counts(scored, label, score)
    return c.select(F.col(score).alias("threshold"), "cum_tp", "cum_fp",
                    (F.col("cum_fp").cast("double") / F.col("total_fp").cast("double")).alias("fpr"),
                    (F.col("cum_tp").cast("double") / F.col("total_tp").cast("double")).alias("tpr"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rows = actual class, columns = predicted 0 / 1."""
    return pred.groupBy(F.col(label).cast("int").alias("actual")) \
        .pivot(prediction, [0, 1]).agg(F.count(F.lit(1))) \
        .select("actual", F.coalesce(F.col("0"), F.lit(0)).alias("predicted_0"),
                F.coalesce(F.col("1"), F.lit(0)).alias("predicted_1"))


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Precision / recall / f1 / support per class, accuracy, macro and weighted avg.

    Zero denominators give 0.0 (scikit-learn's ``zero_division`` warning value).
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def ratio(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))

    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1 = ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn), (tn + fp)
    n = s0 + s1

    def wavg(a, b):
        return F.when(n == 0, F.lit(0.0)).otherwise(
            (a * s0.cast("double") + b * s1.cast("double")) / n.cast("double"))

    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("accuracy", ratio(tp + tn, n), ratio(tp + tn, n), ratio(tp + tn, n), n),
        ("macro avg", (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, n),
        ("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n),
    ]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("class"), a.alias("precision"), b.alias("recall"),
                 d.alias("f1_score"), s.cast("bigint").alias("support"))
        for name, a, b, d, s in rows])).alias("r")).select("r.*")


def idle_days_scorer(activity: DataFrame, idle_days: int = 180) -> DataFrame:
    """A deterministic churn score from days idle: score = d / (d + idle_days),
    prediction = d > idle_days (the gen-1 churn rule).  Customers without any
    purchase have no score and are left out."""
    d = F.col("days_since_last_purchase").cast("double")
    return activity.where(F.col("days_since_last_purchase").isNotNull()).select(
        "customer_id", F.col("is_churned").cast("int").alias("label"),
        (d / (d + float(idle_days))).alias("score"),
        (F.col("days_since_last_purchase") > idle_days).cast("int").alias("prediction"))
