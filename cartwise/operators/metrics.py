"""Quality of a binary classifier.

Input: one row per customer with `churned` (0/1) and `churn_probability`.
"""
from pyspark.sql import functions as F

from ..functions.columns import label_of, position, ratio
from ..schemas import (ACTUAL_LABELS, DECISION_THRESHOLD, METRIC_LABELS, MODEL_LABELS,
                       PREDICTED_LABELS)
from ..staging import checkpointed
from .ranking import running_totals, score_buckets


def score_curve(scored, by=()):
    """One row per distinct probability (and group), with the true and false positives at
    that threshold."""
    by_score = checkpointed(scored.groupBy(*by, "churn_probability").agg(
        F.count_if(F.col("churned") == 1).alias("churners"),
        F.count_if(F.col("churned") == 0).alias("stayers"),
    ).withColumn("threshold_order", -F.col("churn_probability")))
    return running_totals(
        score_buckets(by_score, "threshold_order"), "threshold_order", "bucket",
        {"true_positives": F.col("churners"), "false_positives": F.col("stayers")}, by,
    ).drop("bucket", "threshold_order")


def ranking_metrics(scored, by=()):
    """ROC-AUC with half credit for ties, and average precision as a step function."""
    tp, fp = F.col("true_positives").cast("double"), F.col("false_positives").cast("double")
    below = F.col("churners") * (fp - F.col("stayers") * 0.5)
    totals = score_curve(scored, by).groupBy(*by).agg(
        F.sum("churners").cast("double").alias("p"),
        F.sum("stayers").cast("double").alias("n"),
        F.sum(below).alias("misordered"),
        F.sum(F.col("churners") * F.try_divide(tp, tp + fp)).alias("precision_mass"),
    )
    return totals.select(
        *by,
        (1 - F.try_divide("misordered", F.col("p") * F.col("n"))).alias("roc_auc"),
        F.coalesce(F.try_divide("precision_mass", "p"), F.lit(0.0)).alias("average_precision"),
    )


def roc_auc(scored):
    return ranking_metrics(scored).select("roc_auc")


def average_precision(scored):
    return ranking_metrics(scored).select("average_precision")


def predicted_label(threshold=DECISION_THRESHOLD):
    return (F.col("churn_probability") >= threshold).cast("int")


def threshold_metrics(scored, by=(), threshold=DECISION_THRESHOLD):
    """Precision, recall and F1 of the churners; 0 where the denominator is 0."""
    hit = predicted_label(threshold) == 1
    churned = F.col("churned") == 1
    counts = scored.groupBy(*by).agg(
        F.count_if(hit & churned).alias("tp"),
        F.count_if(hit & ~churned).alias("fp"),
        F.count_if(~hit & churned).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(a, b):
        return F.coalesce(ratio(a, b), F.lit(0.0))

    return counts.select(
        *by,
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(scored, threshold=DECISION_THRESHOLD):
    """Customers per (actual, predicted), with the display order of the labels."""
    cells = scored.groupBy("churned", predicted_label(threshold).alias("predicted_flag")).agg(
        F.count(F.lit(1)).alias("customers"))
    return cells.select(
        label_of("churned", ACTUAL_LABELS).alias("actual"),
        label_of("predicted_flag", PREDICTED_LABELS).alias("predicted"),
        "customers",
        (F.col("churned") + 1).cast("int").alias("actual_order"),
        (F.col("predicted_flag") + 1).cast("int").alias("predicted_order"),
    )


def compare_models(test_scored, fold_scored, names):
    """One row per model: its six metrics and its place in `names`.

    test_scored: model, churned, churn_probability on the test set.
    fold_scored: the same plus fold, predicted by the model that did not see that fold.
    """
    folds = ranking_metrics(fold_scored, ("model", "fold"))
    cv = folds.groupBy("model").agg(F.avg("roc_auc").alias("cv_roc_auc"))
    wide = (
        ranking_metrics(test_scored, ("model",))
        .join(threshold_metrics(test_scored, ("model",)), "model")
        .join(cv, "model")
    )
    return wide.select(
        "model",
        position("model", names).cast("int").alias("model_order"),
        "cv_roc_auc",
        F.col("roc_auc").alias("test_roc_auc"),
        F.col("average_precision").alias("test_pr_auc"),
        F.col("precision").alias("test_precision"),
        F.col("recall").alias("test_recall"),
        F.col("f1").alias("test_f1"),
    )


def best_model(wide):
    """The model with the highest cross-validated ROC-AUC; of equals, the first given."""
    return wide.orderBy(F.desc("cv_roc_auc"), "model_order").limit(1)


def metrics_long(wide):
    """One row per model and metric, labelled and ordered for display."""
    best = best_model(wide).select("model").scalar()
    metric_names = list(METRIC_LABELS)
    labels = F.create_map(*[F.lit(x) for pair in METRIC_LABELS.items() for x in pair])
    models = F.create_map(*[F.lit(x) for pair in MODEL_LABELS.items() for x in pair])
    long = wide.withColumn("is_selected", (F.col("model") == best).cast("int")).unpivot(
        ["model", "is_selected"], metric_names, "key", "value")
    return long.select(
        F.coalesce(models[F.col("model")], F.col("model")).alias("model"),
        labels[F.col("key")].alias("metric"),
        position("key", metric_names).cast("int").alias("metric_order"),
        "value",
        "is_selected",
    )
