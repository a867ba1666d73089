import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import explain, modeling
from cartwise.operators.logistic import FrozenLogistic
from cartwise.plans import frozen
from cartwise.schemas import FEATURE_COLUMNS

from test_modeling import customers  # noqa: F401

N = len(FEATURE_COLUMNS)


def brute_shapley(x, leaves):
    """Average of the marginal contributions over all coalitions of features."""
    def worth(known):
        total = 0.0
        for value, path in leaves:
            for f, (low, high, share) in path.items():
                value = value * (float(low < x[f] <= high) if f in known else share)
            total += value
        return total

    phi = np.zeros(len(x))
    for f in range(len(x)):
        others = [g for g in range(len(x)) if g != f]
        for size in range(len(x)):
            weight = math.factorial(size) * math.factorial(len(x) - size - 1) / math.factorial(len(x))
            for coalition in itertools.combinations(others, size):
                phi[f] += weight * (worth({*coalition, f}) - worth(set(coalition)))
    return phi


@pytest.fixture(scope="module")
def fitted(customers):  # noqa: F811
    return modeling.boosted_trees(rounds=4).fit(customers)


def test_leaf_shapley_equals_brute_force(customers, fitted):  # noqa: F811
    leaves = explain.tree_leaves(fitted)
    rows = customers.limit(3).select(*[F.col(c).cast("double") for c in FEATURE_COLUMNS]).toPandas()
    x = rows.to_numpy()
    expected = np.array([brute_shapley(row, leaves) for row in x])
    assert np.abs(expected).max() > 0
    assert np.allclose(explain.leaf_shapley(x, leaves), expected)


def test_attribution_adds_up_to_the_margin(customers, fitted):  # noqa: F811
    leaves = explain.tree_leaves(fitted)
    total = explain.tree_attribution(customers, leaves).groupBy("customer_id").agg(
        F.sum("phi").alias("phi"), F.count("*").alias("n"))
    predicted = modeling.with_probability(fitted, customers)
    # the boosted margin is half the log odds
    margin = F.log(F.col("churn_probability") / (1 - F.col("churn_probability"))) / 2
    gap = predicted.join(total, "customer_id").agg(
        F.max(F.abs(F.col("phi") + explain.expected_margin(leaves) - margin)), F.min("n"), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == N and gap[2] == 900


def test_linear_attribution_adds_up_to_the_margin(customers):  # noqa: F811
    model = frozen.model()
    phi = explain.linear_attribution(customers, model).groupBy("customer_id").agg(F.sum("phi").alias("phi"))
    both = customers.withColumn("margin", model.margin()).join(phi, "customer_id")
    assert both.agg(F.max(F.abs(F.col("phi") + model.intercept - F.col("margin")))).first()[0] < 1e-9


def test_importance_and_riskiest(spark):
    rows = spark.createDataFrame(
        [(1, "frequency", 1.0, -2.0), (2, "frequency", 1.0, 4.0),
         (1, "monetary", 1.0, 0.5), (2, "monetary", 1.0, 0.5)],
        "customer_id long, feature string, value double, phi double")
    importance = [tuple(r) for r in explain.feature_importance(rows).collect()]
    assert importance == [("frequency", 3.0, "Orders"), ("monetary", 0.5, "Total spend")]
    scores = spark.createDataFrame([(2, 0.9), (1, 0.9), (3, 0.1)], "customer_id long, churn_probability double")
    got = explain.explain_riskiest(scores, rows).collect()
    assert {r["customer_id"] for r in got} == {1} and len(got) == 2


def test_constant_features_have_no_part():
    model = FrozenLogistic(0.0, {c: 1.0 for c in FEATURE_COLUMNS},
                                   {c: 0.0 for c in FEATURE_COLUMNS}, {c: 0.0 for c in FEATURE_COLUMNS})
    assert set(model.contributions()) == set(FEATURE_COLUMNS)
