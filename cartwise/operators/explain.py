"""How much every feature pushes a prediction up or down, on the scale of the raw margin."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from ..schemas import FEATURE_COLUMNS, FEATURE_LABELS
from ..functions.columns import lookup

ATTRIBUTION = ("customer_id", "feature", "value", "phi")


def _long(df, phi):
    """One row per customer and feature from a dictionary of phi columns."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                 phi[c].alias("phi"))
        for c in FEATURE_COLUMNS
    ])
    return df.select("customer_id", F.inline(pairs))


def linear_attribution(features, model):
    """Shapley values of a frozen logistic model: weight * (standardized value - its mean, 0)."""
    return _long(features, model.contributions())


def mean_absolute(attribution):
    return attribution.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))


def feature_importance(attribution):
    """Mean |phi| per feature with its business name, largest first."""
    return (
        mean_absolute(attribution)
        .withColumn("feature_label", lookup("feature", FEATURE_LABELS))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def explain_riskiest(scores, attribution, n=1):
    """Attribution of the n customers with the highest probability."""
    top = scores.orderBy(F.desc("churn_probability"), "customer_id").limit(n)
    return top.select("customer_id", "churn_probability").join(attribution, "customer_id")


def tree_leaves(model):
    """Leaves of fitted boosted trees as arrays.

    For every leaf: its weighted value and, for each feature on its path, the interval that
    leads to it and the share of training rows that took those branches. The size depends on
    the model only: at most 2^depth leaves per tree.
    """
    if hasattr(model, "leaves"):
        return model.leaves()
    booster = model.stages[-1]
    leaves = []

    def walk(node, path, weight):
        if node.numDescendants() == 0:
            leaves.append((weight * node.prediction(), path))
            return
        feature, edge = node.split().featureIndex(), node.split().threshold()
        rows = node.impurityStats().count()
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        left, right = node.leftChild(), node.rightChild()
        walk(left, {**path, feature: (
            low, min(high, edge), share * left.impurityStats().count() / rows)}, weight)
        walk(right, {**path, feature: (
            max(low, edge), high, share * right.impurityStats().count() / rows)}, weight)

    for tree, weight in zip(booster.trees, booster.treeWeights):
        walk(tree._java_obj.rootNode(), {}, weight)
    return leaves


def expected_margin(leaves):
    """Margin of a row about which nothing is known."""
    return float(sum(value * np.prod([share for _, _, share in path.values()])
                     for value, path in leaves))


def _coalition_weight(outside, inside, others):
    """Average over all orders of the product of a leaf's other features.

    A feature that came earlier counts with its real outcome (inside), a later one with its
    training share (outside). Adding one feature at a time, `sums[s]` collects the products
    over coalitions of size s.
    """
    sums = [np.ones(1)]
    for f in others:
        longer = sums + [np.zeros(1)]
        sums = [longer[s] * outside[f] + (sums[s - 1] * inside[f] if s else 0.0)
                for s in range(len(longer))]
    m, weight, total = len(others), 1.0 / (len(others) + 1), 0.0
    for s, coalition in enumerate(sums):
        total = total + weight * coalition
        weight = weight * (s + 1) / (m - s) if s < m else weight
    return total


def leaf_shapley(values, leaves):
    """Exact path-dependent Shapley values: rows x features array, vectorized over the rows."""
    phi = np.zeros(values.shape)
    for leaf_value, path in leaves:
        inside = {f: ((values[:, f] > low) & (values[:, f] <= high)).astype(float)
                  for f, (low, high, _) in path.items()}
        outside = {f: share for f, (_, _, share) in path.items()}
        for f in path:
            others = [g for g in path if g != f]
            phi[:, f] += leaf_value * (inside[f] - outside[f]) * _coalition_weight(
                outside, inside, others)
    return phi


def tree_attribution(features, leaves):
    """Shapley values of the boosted trees with these leaves, (customer_id, feature, value, phi)."""
    leaves = features.sparkSession.sparkContext.broadcast(leaves)
    columns = list(FEATURE_COLUMNS)
    phi_columns = [f"phi_{c}" for c in columns]
    schema = T.StructType(
        [T.StructField("customer_id", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in columns + phi_columns])

    def attribute(batches):
        for batch in batches:
            phi = leaf_shapley(batch[columns].to_numpy(dtype=float), leaves.value)
            yield pd.concat([batch, pd.DataFrame(phi, columns=phi_columns, index=batch.index)], axis=1)

    rows = features.select("customer_id", *[F.col(c).cast("double") for c in columns])
    wide = rows.mapInPandas(attribute, schema)
    return _long(wide, {c: F.col(f"phi_{c}") for c in columns})
