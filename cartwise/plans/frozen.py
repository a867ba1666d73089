"""Fixed models, so that everything behind a model can be checked against plain SQL."""
import numpy as np

from ..operators.logistic import FrozenLogistic
from ..schemas import FEATURE_COLUMNS

# log1p means and deviations of the features in the test data.
FEATURE_MEANS = {
    "recency_days": 4.6284, "frequency": 2.1121, "monetary": 13.8197,
    "avg_order_value": 11.846, "tenure_days": 7.5703, "distinct_products": 3.0,
    "orders_last_90d": 0.2606, "cancel_rate": 0.5861, "is_uk": 0.1074,
}
FEATURE_STDS = {
    "recency_days": 1.0767, "frequency": 0.3177, "monetary": 0.4548,
    "avg_order_value": 0.2487, "tenure_days": 0.2619, "distinct_products": 0.4078,
    "orders_last_90d": 0.3681, "cancel_rate": 0.1175, "is_uk": 0.2509,
}

# Weights that put customers in all three risk levels.
INTERCEPT = 0.35
WEIGHTS = {
    "recency_days": 0.62, "frequency": -0.45, "monetary": -0.21,
    "avg_order_value": 0.12, "tenure_days": -0.09, "distinct_products": -0.17,
    "orders_last_90d": -0.38, "cancel_rate": 0.14, "is_uk": -0.06,
}
# A second model that looks at recency and orders only.
SECOND_INTERCEPT = 0.2
SECOND_WEIGHTS = {c: 0.0 for c in FEATURE_COLUMNS} | {"recency_days": 0.4, "frequency": -0.3}

# Scaling and centres of four clusters of the test data.
RFM_MEANS = {"recency_days": 5.2238, "frequency": 2.0629, "monetary": 13.76}
RFM_STDS = {"recency_days": 1.2468, "frequency": 0.3565, "monetary": 0.5094}
CENTRES = (
    (0.13, 0.93, 0.89),
    (0.63, -1.65, -1.73),
    (-1.55, 0.43, 0.41),
    (0.42, -0.26, -0.19),
)

# Two small trees. Each leaf has a value and, per feature on its path, the
# interval (low, high] and the share of rows that took that branch.
TREE_LEAVES = (
    (-0.8, {"recency_days": (None, 120.0, 0.55), "frequency": (8.0, None, 0.4)}),
    (-0.1, {"recency_days": (None, 120.0, 0.55), "frequency": (None, 8.0, 0.6)}),
    (0.3, {"recency_days": (120.0, None, 0.45), "orders_last_90d": (0.0, None, 0.1)}),
    (0.9, {"recency_days": (120.0, None, 0.45), "orders_last_90d": (None, 0.0, 0.9)}),
    (-0.4, {"monetary": (900000.0, None, 0.5), "cancel_rate": (None, 1.0, 0.9)}),
    (0.2, {"monetary": (900000.0, None, 0.5), "cancel_rate": (1.0, None, 0.1)}),
    (0.5, {"monetary": (None, 900000.0, 0.5), "distinct_products": (None, 15.0, 0.3)}),
    (0.1, {"monetary": (None, 900000.0, 0.5), "distinct_products": (15.0, None, 0.7)}),
)


def model():
    return FrozenLogistic(INTERCEPT, WEIGHTS, FEATURE_MEANS, FEATURE_STDS)


def second_model():
    return FrozenLogistic(SECOND_INTERCEPT, SECOND_WEIGHTS, FEATURE_MEANS, FEATURE_STDS)


def leaves():
    """The trees in the form tree_attribution takes."""
    def interval(low, high, share):
        return (-np.inf if low is None else low, np.inf if high is None else high, share)

    return [(value, {FEATURE_COLUMNS.index(c): interval(*where) for c, where in path.items()})
            for value, path in TREE_LEAVES]


