import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwise.operators import modeling
from cartwise.schemas import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def customers(spark):
    """900 customers whose churn depends on recency and orders."""
    i = F.col("id")
    noise = (F.xxhash64(i, F.lit("noise")) % 1000) / 1000.0
    recency = F.pmod(F.xxhash64(i, F.lit("recency")), 300)
    orders = 1 + F.pmod(F.xxhash64(i, F.lit("orders")), 12)
    spend = 20.0 + F.pmod(F.xxhash64(i, F.lit("spend")), 5000)
    return spark.range(900).select(
        i.alias("customer_id"), recency.alias("recency_days"), orders.alias("frequency"),
        spend.alias("monetary"), (spend / orders).alias("avg_order_value"),
        (recency + 10 * orders).alias("tenure_days"),
        F.pmod(F.xxhash64(i, F.lit("products")), 40).alias("distinct_products"),
        F.when(recency < 90, 1.0).otherwise(0.0).alias("orders_last_90d"),
        F.abs(noise).alias("cancel_rate"), (i % 2).cast("int").alias("is_uk"),
        (recency / 100.0 - orders / 6.0 + noise > 0).cast("int").alias("churned"),
    )


def class_sizes(df):
    return {r["churned"]: r["count"] for r in df.groupBy("churned").count().collect()}


def test_split_is_exact_disjoint_and_whole(customers):
    train, test = modeling.stratified_split(customers)
    whole, tested = class_sizes(customers), class_sizes(test)
    assert sum(tested.values()) == math.ceil(0.2 * 900)
    assert all(abs(tested[label] - 0.2 * n) < 1 for label, n in whole.items())
    assert train.columns == test.columns == customers.columns
    assert train.count() + test.count() == 900
    assert train.join(test, "customer_id", "left_semi").count() == 0


@pytest.mark.parametrize("sizes, expected", [
    ({0: 2196, 1: 2110}, {0: 440, 1: 422}),   # 4,306 rows: 862 in the test set
    ({0: 7, 1: 3}, {0: 1, 1: 1}),             # 8 train rows: 5.6 and 2.4
    ({0: 5, 1: 5, 2: 1}, {0: 1, 1: 2, 2: 0}), # 8 train rows: 3.64, 3.64 (a tie) and 0.73
    ({0: 1}, {0: 1}),
])
def test_split_sizes(spark, sizes, expected):
    rows = [(label,) for label, n in sizes.items() for _ in range(n)]
    got = modeling.split_sizes(spark.createDataFrame(rows, "churned int"))
    assert {r["churned"]: r["test_size"] for r in got.collect()} == expected


def test_split_depends_on_the_seed_and_not_on_partitions(customers):
    def ids(df, seed):
        return sorted(r[0] for r in modeling.stratified_split(df, seed=seed)[1].select("customer_id").collect())

    assert ids(customers, 42) == ids(customers.repartition(5, "is_uk"), 42) != ids(customers, 43)


def test_folds_are_stratified(customers):
    cells = modeling.with_folds(customers).groupBy("churned", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in cells if r["churned"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_logistic_regression_minimizes_the_penalized_loss(customers):
    """Gradient of |w|^2 / 2 + c * sum of log losses is zero, on population-scaled features."""
    model = modeling.logistic_regression(900).fit(customers)
    rows = customers.toPandas()
    logs = np.log1p(rows[list(FEATURE_COLUMNS)].to_numpy(dtype=float))
    z, y = (logs - logs.mean(0)) / logs.std(0), rows["churned"].to_numpy()
    w = np.array(model.stages[-1].coefficients) * np.sqrt(899 / 900)
    error = 1 / (1 + np.exp(-(z @ w + model.stages[-1].intercept))) - y
    assert np.abs(w + z.T @ error).max() < 0.05
    assert abs(error.sum()) < 0.05
    assert np.abs(z.T @ y).max() > 10  # the scale of a gradient that is not zero


def test_column_expressions_equal_the_fitted_model(customers, tmp_path):
    path = str(tmp_path / "logistic")
    modeling.save_model(modeling.logistic_regression(900).fit(customers), path)
    model = modeling.load_model(path)
    both = modeling.with_probability(model, customers).select("customer_id", "churn_probability").join(
        model.transform(customers).select("customer_id", vector_to_array("probability")[1].alias("q")),
        "customer_id")
    assert both.agg(F.max(F.abs(F.col("churn_probability") - F.col("q")))).first()[0] < 1e-9


def test_training_selects_records_and_saves(spark, customers, tmp_path):
    training = modeling.train_and_select(customers, modeling.make_models(rounds=5), folds=3)
    wide = {r["model"]: r for r in training.wide.collect()}
    assert set(wide) == {"logistic_regression", "boosted_trees"}
    assert all(0.8 < r["cv_roc_auc"] <= 1 and 0.7 < r["test_roc_auc"] <= 1 for r in wide.values())
    assert training.best_name == max(wide, key=lambda m: wide[m]["cv_roc_auc"])
    assert training.metrics_table().count() == 12
    cells = training.confusion_table().collect()
    assert sum(r["customers"] for r in cells) == training.test.count()

    runs = {r["model"]: r for r in modeling.training_runs(training).collect()}
    assert runs["boosted_trees"]["params"]["rounds"] == "5"
    assert runs["logistic_regression"]["metrics"]["cv_roc_auc"] == wide["logistic_regression"]["cv_roc_auc"]
    assert len({r["run_id"] for r in runs.values()}) == 2

    path = str(tmp_path / "model")
    modeling.save_model(training.best, path)
    before = modeling.with_probability(training.best, training.test)
    after = modeling.with_probability(modeling.load_model(path), training.test)
    assert before.exceptAll(after).count() == 0


def test_default_models_have_the_published_settings():
    logistic = modeling.logistic_regression(1000).getStages()[-1]
    assert logistic.getMaxIter() == 1000 and logistic.getElasticNetParam() == 0
    assert logistic.getRegParam() == pytest.approx(0.001, rel=0.01)
    trees = modeling.boosted_trees().getStages()[-1]
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), trees.getSubsamplingRate(),
            trees.getFeatureSubsetStrategy(), trees.getSeed()) == (300, 3, 0.05, 0.8, "0.8", 42)
