"""Measures, labels and queries behind a dashboard.

A measure is an aggregate evaluated in a filter context: the group it is shown for and the
slicers of the page. Slicers are optional lists of values and filter before aggregation.
Measures about high-risk customers fix the risk level themselves, so they ignore a risk
slicer; shares divide by the total of the whole table, so their total ignores every slicer.
"""
from pyspark.sql import functions as F

from ..functions.columns import exact_sum, lookup, position, probability_band, ratio
from ..schemas import FEATURE_LABELS, RISK_LEVELS, SEGMENTS, SPANISH

ACTION_COLUMNS = ("customer_id", "segment", "churn_probability", "recency_days", "frequency",
                  "monetary", "avg_order_value", "tenure_days", "orders_last_90d",
                  "distinct_products")


# Labels and business order

def localize(df, column, labels, name=None):
    """Add a translated label column; labels without a translation stay as they are."""
    return df.withColumn(name or f"{column}_es", lookup(column, labels))


def untranslated_labels(df, columns, dictionaries):
    """(column, label) of every label in df that its dictionary does not have."""
    rows = [(c, k) for c in columns for k in dictionaries[c]]
    known = df.sparkSession.createDataFrame(rows, "label_column string, label string")
    labels = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("label_column"), F.col(c).alias("label")) for c in columns])))
    return (
        labels.where(F.col("label").isNotNull()).distinct()
        .join(known, ["label_column", "label"], "left_anti")
    )


def report_segments(segments):
    return localize(segments.withColumn("segment_order", position("segment", SEGMENTS)),
                    "segment", SPANISH["segment"])


def report_scores(scores):
    ordered = report_segments(scores).withColumns({
        "risk_order": position("risk_level", RISK_LEVELS),
        "probability_band": probability_band("churn_probability"),
    })
    return localize(ordered, "risk_level", SPANISH["risk_level"])


def report_metrics(long_metrics):
    return localize(localize(long_metrics, "model", SPANISH["model"]), "metric", SPANISH["metric"])


def report_confusion(confusion):
    return localize(localize(confusion, "actual", SPANISH["actual"]),
                    "predicted", SPANISH["predicted"])


def report_importance(importance):
    labelled = importance.withColumn("feature_label", lookup("feature", FEATURE_LABELS))
    return localize(labelled, "feature", SPANISH["feature"], "feature_label_es")


# Slicers

def slicer_values(df, column):
    return df.select(column).distinct()


def sliced(df, **slicers):
    """Keep the rows whose column has one of the chosen values; None means no choice."""
    for column, values in slicers.items():
        if values is not None:
            df = df.where(F.col(column).isin(*values))
    return df


# Segments page

SEGMENT_MEASURES = {
    "customers": "count(*)",
    "revenue": "sum(monetary)",
    "revenue_share": "sum(monetary)",
    "customer_share": "count(*)",
    "avg_days_since_last_order": "avg(recency_days)",
    "avg_orders": "avg(frequency)",
    "avg_spend": "avg(monetary)",
}


def segment_measures(segments, names, by=(), segment_slicer=None):
    """Chosen segment measures, for the whole table or per group.

    Shares divide by the total of all segments, a scalar subquery within the plan.
    """
    measured = sliced(segments, segment=segment_slicer).groupBy(*by).agg(
        *[F.expr(SEGMENT_MEASURES[n]).alias(n) for n in names])
    return measured.withColumns({
        n: ratio(n, segments.agg(F.expr(SEGMENT_MEASURES[n])).scalar())
        for n in names if n.endswith("_share")})


def segment_kpis(segments, segment_slicer=None):
    return segment_measures(segments, ("customers", "revenue", "avg_spend", "avg_orders"),
                            segment_slicer=segment_slicer)


def shares_by_segment(segments, label="segment"):
    keys = ("segment_order", label)
    return segment_measures(
        report_segments(segments), ("customer_share", "revenue_share"), keys).orderBy(*keys)


def segment_profile(segments, label="segment"):
    keys = ("segment_order", label)
    names = ("customers", "avg_days_since_last_order", "avg_orders", "avg_spend", "revenue_share")
    return segment_measures(report_segments(segments), names, keys).orderBy(*keys)


def spend_scatter(segments):
    """One point per customer: days since the last order, spend and its logarithm."""
    points = segments.groupBy("customer_id", "segment").agg(
        F.sum("recency_days").alias("recency_days"), F.sum("monetary").alias("monetary"))
    return points.withColumn(
        "log_monetary", F.when(F.col("monetary") > 0, F.log10("monetary")))


# Risk page

def risk_measures(scores, by=(), segment_slicer=None, risk_slicer=None):
    """Customers scored, high-risk customers, their share and spend, average probability."""
    in_context = F.lit(True) if risk_slicer is None else F.coalesce(
        F.col("risk_level").isin(*risk_slicer), F.lit(False))
    high = F.col("risk_level") == "High"
    return sliced(scores, segment=segment_slicer).groupBy(*by).agg(
        F.count_if(in_context).alias("customers_scored"),
        F.count_if(high).alias("high_risk_customers"),
        ratio(F.count_if(high), F.count_if(in_context)).alias("high_risk_share"),
        F.sum(F.when(high, F.col("monetary"))).alias("revenue_at_risk"),
        F.avg(F.when(in_context, F.col("churn_probability"))).alias("avg_churn_probability"),
    )


def risk_kpis(scores, segment_slicer=None, risk_slicer=None):
    return risk_measures(scores, (), segment_slicer, risk_slicer).drop("avg_churn_probability")


def customers_by_segment_and_risk(scores, segment_slicer=None, risk_slicer=None,
                                  labels=("segment", "risk_level")):
    keys = ("segment_order", "risk_order", *labels)
    chosen = sliced(report_scores(scores), segment=segment_slicer, risk_level=risk_slicer)
    return chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers")).orderBy(*keys)


def avg_probability_by_segment(scores, segment_slicer=None, risk_slicer=None, label="segment"):
    keys = ("segment_order", label)
    chosen = sliced(report_scores(scores), segment=segment_slicer, risk_level=risk_slicer)
    return chosen.groupBy(*keys).agg(
        F.avg("churn_probability").alias("avg_churn_probability")).orderBy(*keys)


def probability_bands(scores, segment_slicer=None, risk_slicer=None, label="risk_level"):
    keys = ("probability_band", "risk_order", label)
    chosen = sliced(report_scores(scores), segment=segment_slicer, risk_level=risk_slicer)
    return chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers")).orderBy(*keys)


# Measure cube

CUBE = ("segment", "risk_level", "probability_band")


def risk_cube(scores):
    """Customers, spend and summed probability per segment, risk level and probability band.

    A row for each combination that occurs, a few dozen at most whatever the number of customers. Every
    measure of the risk page follows from sums of these rows, for any slicers.
    """
    return (scores.withColumn("probability_band", probability_band("churn_probability")).groupBy(*CUBE)
            .agg(F.count(F.lit(1)).alias("customers"), exact_sum("monetary").alias("monetary"),
                 F.sum("churn_probability").alias("probability")))


def cube_measures(cube, by=(), segment_slicer=None, risk_slicer=None):
    """The measures of risk_measures, from the cube."""
    in_context = F.lit(True) if risk_slicer is None else F.coalesce(
        F.col("risk_level").isin(*risk_slicer), F.lit(False))
    high = F.col("risk_level") == "High"

    def total(column, condition):
        return F.sum(F.when(condition, F.col(column)))

    def customers(condition):
        return F.coalesce(total("customers", condition), F.lit(0))

    return sliced(cube, segment=segment_slicer).groupBy(*by).agg(
        customers(in_context).alias("customers_scored"), customers(high).alias("high_risk_customers"),
        ratio(customers(high), customers(in_context)).alias("high_risk_share"),
        total("monetary", high).cast("double").alias("revenue_at_risk"),
        ratio(total("probability", in_context), customers(in_context)).alias("avg_churn_probability"))


def cube_totals(cube):
    """Measures for every set of the three columns at once; `level` tells which are summed over (bit set)."""
    return cube.cube(*CUBE).agg(
        F.grouping_id(*CUBE).alias("level"), F.sum("customers").alias("customers"),
        F.sum("monetary").cast("double").alias("revenue"),
        ratio(F.sum("probability"), F.sum("customers")).alias("avg_churn_probability"))


# Action page

def action_list(scores, limit=None, segment_slicer=None):
    """High-risk customers, the most valuable first."""
    chosen = sliced(scores, risk_level=["High"], segment=segment_slicer)
    listed = chosen.select(*ACTION_COLUMNS).orderBy(F.desc("monetary"), "customer_id")
    return listed if limit is None else listed.limit(limit)


def action_kpis(scores, segment_slicer=None):
    return risk_measures(scores, (), segment_slicer, ["High"]).select(
        "high_risk_customers", "revenue_at_risk")


# Model page

def model_kpis(long_metrics):
    """Numbers of the selected model, and its gain over the other one."""
    def value(metric, selected=1):
        return F.sum(F.when((F.col("metric") == metric) & (F.col("is_selected") == selected),
                            F.col("value")))

    return long_metrics.agg(
        value("Test ROC-AUC").alias("selected_test_roc_auc"),
        value("Recall").alias("selected_recall"),
        value("Precision").alias("selected_precision"),
        (value("CV ROC-AUC") - value("CV ROC-AUC", 0)).alias("cv_roc_auc_gain"),
    )


def metrics_by_model(long_metrics, labels=("metric", "model")):
    keys = ("metric_order", *labels)
    return report_metrics(long_metrics).groupBy(*keys).agg(
        F.sum("value").alias("value")).orderBy(*keys)


def confusion_pivot(confusion, labels=("actual", "predicted")):
    """Actual in rows, predicted in columns; a pair that does not occur stays empty."""
    actual, predicted = labels
    columns = [SPANISH["predicted"][p] if predicted.endswith("_es") else p
               for p in SPANISH["predicted"]]
    return (
        report_confusion(confusion).groupBy("actual_order", actual)
        .pivot(predicted, columns).agg(F.sum("customers"))
        .orderBy("actual_order")
    )


def confusion_total(confusion):
    return confusion.agg(F.sum("customers").alias("test_customers"))


def importance_chart(importance, label="feature_label"):
    return report_importance(importance).groupBy(label).agg(
        F.sum("mean_abs_shap").alias("mean_abs_shap")).orderBy(F.desc("mean_abs_shap"), label)
