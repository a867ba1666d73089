"""Validate, score and risk-band customers."""
from pyspark.sql import functions as F

from ..functions.columns import risk_level, round_half_even
from ..schemas import (DECISION_THRESHOLD, FEATURE_RANGES, HOME_COUNTRY,
                       RISK_LEVELS)
from .features import eligible, features_as_of
from .modeling import with_probability


def score_features(features, model, segments=None, max_recency_days=None):
    """Probability and risk level; segments are joined where they are known."""
    current = features if max_recency_days is None else eligible(features, max_recency_days)
    scores = with_probability(model, current).withColumn(
        "risk_level", risk_level("churn_probability"))
    if segments is None:
        return scores
    return scores.join(segments.select("customer_id", "segment"), "customer_id", "left")


def score_customers(lines, as_of, model, segments, home_country=HOME_COUNTRY,
                    max_recency_days=365):
    """Score the current customers of an activity table as of a date."""
    features = features_as_of(lines, as_of, home_country)
    return score_features(features, model, segments, max_recency_days)


def segment_risk_matrix(scores):
    """Customers per segment (rows) and risk level (columns). Missing segments are left out."""
    return (
        scores.where(F.col("segment").isNotNull())
        .groupBy("segment").pivot("risk_level", list(RISK_LEVELS)).count()
        .fillna(0, subset=list(RISK_LEVELS))
    )


def riskiest_customers(scores, n=1):
    return scores.orderBy(F.desc("churn_probability"), "customer_id").limit(n)


def violations():
    """Array column with the names of the fields that are missing or out of range."""
    def broken(c, low, high):
        value = F.col(c).cast("double")
        bad = value.isNull() | F.isnan(value) | (value < low)
        if high is not None:
            bad = bad | (value > high)
        return F.when(bad, F.lit(c))

    return F.array_compact(F.array(*[broken(c, *r) for c, r in FEATURE_RANGES.items()]))


def validate_features(rows):
    """(valid rows, rejected rows with the list of fields at fault)."""
    checked = rows.withColumn("violations", violations())
    return (checked.where(F.size("violations") == 0).drop("violations"),
            checked.where(F.size("violations") > 0))


def predict(rows, model):
    """Answer for valid feature rows: the decision uses the probability before rounding."""
    valid, _ = validate_features(rows)
    p = F.col("churn_probability")
    return with_probability(model, valid).withColumns({
        "will_churn": p >= DECISION_THRESHOLD,
        "churn_probability": round_half_even(p, 4),
    })
