"""Evaluation on a scored table (label 0/1, score in [0, 1]): classification metrics (M6),
confusion matrix (M8), threshold sweep with first-maximum argmax (M9, T4), ROC and
precision-recall points (W2, W3), model comparison (M7, T3).

Ranking metrics never sort the rows: the scores are collapsed to a histogram of distinct
values (``groupBy(score)``, map-side combined), and cumulative counts come from the bucketed
running totals of ``operators.cumulative``. ROC-AUC is the trapezoid over distinct
thresholds; average precision is the step sum sum((tp/P) * precision), not Spark's
trapezoidal ``areaUnderPR``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark.operators.cumulative import running_totals
from ontime_spark.session import materialize

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
SWEEP_METRICS = ("f1", "precision", "recall")


def _safe_div(a: F.Column, b: F.Column) -> F.Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def score_histogram(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, tp, fp): positives and negatives per distinct score."""
    y = F.col(label).cast("double")
    return (scored.where(F.col(score).isNotNull())
                  .groupBy(F.col(score).cast("double").alias("score"))
                  .agg(F.sum(y).alias("tp"), F.sum(1.0 - y).alias("fp")))


def cumulative_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Histogram with cumulative counts from the highest score down: cum_tp, cum_fp."""
    return running_totals(score_histogram(scored, label, score), [], "score", ["tp", "fp"],
                          descending=True)


def classification_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                           threshold: float = 0.5, model: str | None = None) -> DataFrame:
    """M6: accuracy, precision, recall, f1 (0 when undefined), roc_auc, pr_auc in one row.

    The predicted class is ``score > threshold`` (a fitted classifier's ``predict``). All six
    come from one aggregation over the cumulative score histogram: the confusion counts are
    the histogram sums above the threshold."""
    c = cumulative_curve(scored, label, score)
    above = F.col("score") > threshold
    agg = c.agg(
        F.sum(F.when(above, F.col("tp")).otherwise(0.0)).alias("_tp"),
        F.sum(F.when(above, F.col("fp")).otherwise(0.0)).alias("_fp"),
        F.sum("tp").alias("_p"), F.sum("fp").alias("_n"),
        F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2)).alias("_auc"),
        F.sum(F.col("tp") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("_ap"))
    tp, fp, p, n = F.col("_tp"), F.col("_fp"), F.col("_p"), F.col("_n")
    fn, tn = p - tp, n - fp
    out = agg.select(
        *([F.lit(model).alias("model")] if model is not None else []),
        _safe_div(tp + tn, p + n).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _safe_div(F.col("_auc"), p * n).alias("roc_auc"),
        _safe_div(F.col("_ap"), p).alias("pr_auc"))
    return out


def confusion_matrix(scored: DataFrame, label: str = "label", score: str = "score",
                     prediction: F.Column | None = None, threshold: float = 0.5) -> DataFrame:
    """M8: (label, prediction, n, rate) with rate normalised over each true label."""
    pred = prediction if prediction is not None else (F.col(score) > threshold)
    counts = scored.groupBy(F.col(label).cast("int").alias("label"),
                            pred.cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    per_label = Window.partitionBy("label")  # at most two rows per label
    return counts.withColumn("rate", F.col("n") / F.sum("n").over(per_label))


def roc_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score (descending): tpr, fpr at threshold = score."""
    c = cumulative_curve(scored, label, score)
    tot = c.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n")).first()
    p, n = float(tot["p"] or 0), float(tot["n"] or 0)
    return c.select("score", "cum_tp", "cum_fp",
                    (F.col("cum_tp") / F.lit(p) if p else F.lit(0.0)).alias("tpr"),
                    (F.col("cum_fp") / F.lit(n) if n else F.lit(0.0)).alias("fpr"))


def roc_corners(scored: DataFrame, label: str = "label", score: str = "score", buckets: int = 8) -> DataFrame:
    """W2 as it is drawn: the start (0, 0) with a null score, and the points at which the curve's step
    changes; a point between two equal steps lies on the line of its neighbours. The number of
    points follows the curve's corners, not the rows.

    The step of a point is its score's (tp, fp). The next lower score is looked up inside a range
    bucket, and for the last one of a bucket in the next bucket's first row."""
    curve = cumulative_curve(scored, label, score)
    ranged = materialize(curve.repartitionByRange(buckets, F.desc("score")).withColumn("_bucket", F.spark_partition_id()), "curve")
    tot = ranged.agg(F.max("cum_tp").alias("p"), F.max("cum_fp").alias("n")).first()
    step = F.struct("tp", "fp")
    firsts = ranged.groupBy("_bucket").agg(F.max_by(step, "score").alias("first"))
    after = firsts.select("_bucket", F.lead("first").over(Window.orderBy("_bucket")).alias("_after"))  # a row for each bucket
    down = Window.partitionBy("_bucket").orderBy(F.desc("score"))
    seen = ranged.withColumn("_next", F.lead(step).over(down)).join(F.broadcast(after), "_bucket")
    following = F.coalesce("_next", "_after")
    kept = seen.where(following.isNull() | (following != step) | ((F.col("cum_tp") == F.col("tp")) & (F.col("cum_fp") == F.col("fp"))))
    share = lambda c, total: (F.col(c) / F.lit(float(total)) if total else F.lit(0.0)).alias({"cum_tp": "tpr", "cum_fp": "fpr"}[c])
    points = kept.select("score", share("cum_tp", tot["p"]), share("cum_fp", tot["n"]))
    start = scored.sparkSession.createDataFrame([(None, 0.0, 0.0)], "score double, tpr double, fpr double")
    return points.unionByName(start)


def pr_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall per distinct score threshold, plus the base rate."""
    c = cumulative_curve(scored, label, score)
    tot = c.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n")).first()
    p, n = float(tot["p"] or 0), float(tot["n"] or 0)
    return c.select("score",
                    (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
                    (F.col("cum_tp") / F.lit(p) if p else F.lit(0.0)).alias("recall"),
                    F.lit(p / (p + n) if p + n else 0.0).alias("base_rate"))


def _threshold_index(score: F.Column, lo: int, hi: int) -> F.Column:
    """Number of grid thresholds i/100 (lo <= i <= hi) that are <= score, computed exactly:
    k = floor(100*score) corrected by comparing with the doubles k/100 and (k+1)/100."""
    k0 = F.floor(score * 100).cast("long")
    k = (F.when((k0 + 1).cast("double") / 100 <= score, k0 + 1)
          .when(k0.cast("double") / 100 > score, k0 - 1).otherwise(k0))
    return F.greatest(F.least(k, F.lit(hi)) - F.lit(lo - 1), F.lit(0))


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score",
                    lo: int = 10, hi: int = 90) -> DataFrame:
    """M9: precision, recall and f1 of ``score >= i/100`` for every i in [lo, hi] (81 grid
    thresholds by default). The rows are reduced to counts per grid cell first (<= 82 groups),
    so the sweep itself runs on a fixed-size table."""
    spark = scored.sparkSession
    y = F.col(label).cast("long")
    cells = (scored.where(F.col(score).isNotNull())
                   .groupBy(_threshold_index(F.col(score).cast("double"), lo, hi).alias("j"))
                   .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))
    # Cell 0 holds the scores below the lowest threshold: counted in P, never predicted 1.
    grid = spark.range(0, hi - lo + 2).select(F.col("id").alias("j"))
    table = grid.join(F.broadcast(cells), "j", "left").fillna(0, ["pos", "neg"])
    down = Window.orderBy(F.desc("j")).rowsBetween(Window.unboundedPreceding, 0)  # 81 rows
    everything = Window.partitionBy()
    table = table.select(
        "j", ((F.col("j") + lo - 1).cast("double") / 100).alias("threshold"),
        F.sum("pos").over(down).cast("double").alias("tp"),
        F.sum("neg").over(down).cast("double").alias("fp"),
        F.sum("pos").over(everything).cast("double").alias("p"))
    tp, fp, p = F.col("tp"), F.col("fp"), F.col("p")
    fn = p - tp
    return table.where(F.col("j") >= 1).select(
        "threshold",
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def best_thresholds(sweep: DataFrame, metrics: tuple[str, ...] = SWEEP_METRICS) -> DataFrame:
    """T4: per metric the threshold with the highest value; the first (smallest) threshold
    wins ties. Rows: metric, threshold, value."""
    for m in metrics:
        if m not in SWEEP_METRICS:
            raise ValueError(f"the sweep has no metric {m!r}, only {', '.join(SWEEP_METRICS)}")
    long = sweep.select("threshold", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))
    best = long.groupBy("metric").agg(F.max_by(F.struct("threshold", "value"),
                                               F.struct("value", -F.col("threshold"))).alias("b"))
    return best.select("metric", "b.threshold", "b.value")


def find_optimal_threshold(scored: DataFrame, metric: str = "f1", label: str = "label",
                           score: str = "score") -> float:
    """M9 as a scalar (the reference's return value)."""
    row = best_thresholds(threshold_sweep(scored, label, score), (metric,)).first()
    return float(row["threshold"])


def compare_models(metrics_by_model: Mapping[str, DataFrame]) -> DataFrame:
    """M7 + T3: one row per model, ordered by pr_auc descending."""
    rows = None
    for name, m in metrics_by_model.items():
        r = m.select(F.lit(name).alias("model"), *METRICS)
        rows = r if rows is None else rows.unionByName(r)
    return rows.orderBy(F.desc("pr_auc"))
