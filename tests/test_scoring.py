import pytest
from pyspark.sql import functions as F

from cartwise.functions import columns
from cartwise.operators import scoring
from cartwise.operators.logistic import FrozenLogistic
from cartwise.plans import frozen
from cartwise.schemas import FEATURES

LOYAL = (1, 5.0, 40.0, 25000.0, 625.0, 700.0, 300.0, 8.0, 0.05, 1.0)
ONE_TIME = (2, 300.0, 1.0, 80.0, 80.0, 300.0, 2.0, 0.0, 0.05, 1.0)


def rows(spark, *values):
    return spark.createDataFrame(list(values), FEATURES)


def changed(customer, **fields):
    return tuple(fields.get(f.name, v) for f, v in zip(FEATURES.fields, customer))


def test_probability_decision_and_order(spark):
    got = {r["customer_id"]: r for r in scoring.predict(rows(spark, LOYAL, ONE_TIME), frozen.model()).collect()}
    assert 0 <= got[1]["churn_probability"] < got[2]["churn_probability"] <= 1
    assert got[2]["will_churn"] and not got[1]["will_churn"]
    assert all(r["churn_probability"] == round(r["churn_probability"], 4) for r in got.values())


def test_decision_uses_the_probability_before_rounding(spark):
    df = rows(spark, LOYAL).withColumn("p", F.lit(0.49996))

    class Fixed(FrozenLogistic):
        def with_probability(self, features):
            return features.withColumn("churn_probability", F.col("p"))

    row = scoring.predict(df, Fixed(0, {}, {}, {})).first()
    assert row["churn_probability"] == 0.5 and row["will_churn"] is False


@pytest.mark.parametrize("fields, names", [
    ({"recency_days": -1.0}, ["recency_days"]),
    ({"frequency": 0.0, "is_uk": 2.0}, ["frequency", "is_uk"]),
    ({"distinct_products": 0.5}, ["distinct_products"]),
    ({"cancel_rate": float("nan")}, ["cancel_rate"]),
    ({"monetary": None}, ["monetary"]),
])
def test_bad_rows_are_rejected(spark, fields, names):
    valid, rejected = scoring.validate_features(rows(spark, changed(LOYAL, **fields), ONE_TIME))
    assert [r["customer_id"] for r in valid.collect()] == [2]
    assert rejected.first()["violations"] == names


def test_limits_are_accepted(spark):
    edge = changed(LOYAL, recency_days=0.0, frequency=1.0, is_uk=0.0, cancel_rate=3.0)
    assert scoring.validate_features(rows(spark, edge))[0].count() == 1


def test_risk_levels_and_bands(spark):
    df = spark.createDataFrame(
        [(0.7,), (0.699999,), (0.4,), (0.39,), (float("nan"),), (1.0,)], "p double")
    got = [tuple(r) for r in df.select(
        columns.risk_level("p"), F.when(~F.isnan("p"), columns.probability_band("p"))).collect()]
    assert got == [("High", 0.7), ("Medium", 0.6), ("Medium", 0.4), ("Low", 0.3), ("Low", None), ("High", 1.0)]


def test_scores_keep_customers_without_segment(spark):
    segments = spark.createDataFrame([(1, "Champions")], "customer_id long, segment string")
    far = changed(ONE_TIME, customer_id=3, recency_days=366.0)
    scores = scoring.score_features(rows(spark, LOYAL, ONE_TIME, far), frozen.model(), segments, 365)
    got = {r["customer_id"]: r["segment"] for r in scores.collect()}
    assert got == {1: "Champions", 2: None}
    assert scores.columns == [*FEATURES.names, "churn_probability", "risk_level", "segment"]
    matrix = [tuple(r) for r in scoring.segment_risk_matrix(scores).collect()]
    assert matrix == [("Champions", 0, 0, 1)]


def test_riskiest_takes_the_first_of_equals(spark):
    scores = spark.createDataFrame([(9, 0.8), (4, 0.8), (5, 0.1)], "customer_id long, churn_probability double")
    assert [r["customer_id"] for r in scoring.riskiest_customers(scores).collect()] == [4]
    assert [r["customer_id"] for r in scoring.riskiest_customers(scores, 2).collect()] == [4, 9]


def test_totals_are_exact_and_rounded_once(spark):
    amounts = spark.createDataFrame([(2.49996,), (0.0,), (float("nan"),), (None,)], "a double")
    total = amounts.agg(columns.exact_sum("a").alias("t")).select(
        columns.round_half_up("t"), columns.round_total_half_even("t"), columns.round_half_up("t", 4))
    assert tuple(total.first()) == (2.0, 2.0, 2.5)
    many = spark.range(3000).selectExpr("if(id % 3 = 0, 1e9, if(id % 3 = 1, -1e9, 0.1D)) AS a")
    orders = [many.orderBy("a"), many.orderBy(F.desc("a")), many.repartition(5)]
    assert {str(df.agg(columns.exact_sum("a")).first()[0]) for df in orders} == {"100.000000"}


def test_rounding_rules(spark):
    df = spark.createDataFrame([(2.5, 0.125)], "a double, b double")
    assert tuple(df.select(
        columns.round_half_up("a"), columns.round_half_even("a"),
        columns.round_half_up("b", 2), columns.round_half_even("b", 2)).first()) == (3.0, 2.0, 0.13, 0.12)
