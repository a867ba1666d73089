"""A logistic model with known numbers, evaluated as plain column expressions."""
import math

from pyspark.sql import functions as F

from ..functions.columns import sum_of
from ..schemas import FEATURE_COLUMNS


class FrozenLogistic:
    """A logistic model with known numbers, evaluated as plain column expressions.

    margin = intercept + sum of weight * (log1p(x) - mean) / std
    """

    def __init__(self, intercept, weights, means, stds):
        self.intercept, self.weights, self.means, self.stds = intercept, weights, means, stds

    @classmethod
    def from_fitted(cls, pipeline_model):
        scaler, logistic = pipeline_model.stages[-2], pipeline_model.stages[-1]

        def named(values):
            return dict(zip(FEATURE_COLUMNS, (float(v) for v in values)))

        return cls(float(logistic.intercept), named(logistic.coefficients),
                   named(scaler.mean), named(scaler.std))

    def contributions(self):
        """Feature -> its part of the margin, relative to the training mean."""
        def part(c):
            if not self.stds[c] or math.isnan(self.stds[c]):
                return F.lit(0.0)
            z = (F.log1p(F.col(c).cast("double")) - self.means[c]) / self.stds[c]
            return self.weights[c] * z

        return {c: part(c) for c in FEATURE_COLUMNS}

    def margin(self):
        return F.lit(self.intercept) + sum_of(list(self.contributions().values()))

    def with_probability(self, features):
        return features.withColumn("churn_probability", 1 / (1 + F.exp(-self.margin())))
