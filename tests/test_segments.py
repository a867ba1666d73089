import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import frames
from cartwise.operators import segments
from cartwise.plans.registry import over_folder

PROFILE = "cluster int, recency_days double, frequency double, monetary double"


def test_rfm_counts_calendar_days(spark):
    clean = frames.purchases(spark, [
        (1, "A", "2011-12-09 10:00:00", 10.0), (1, "A", "2011-12-09 10:00:00", 5.0),
        (1, "B", "2011-12-01 23:59:00", 1.0), (2, "C", "2011-12-08 23:59:00", 2.0)])
    assert sorted(tuple(r) for r in segments.rfm(clean).collect()) == [(1, 1, 2, 16.0), (2, 2, 1, 2.0)]


def test_scaling_has_zero_mean_and_unit_population_variance(spark):
    df = spark.createDataFrame([(1, 3, 10.0), (5, 3, 100.0), (50, 3, 4000.0)],
                               "recency_days int, frequency long, monetary double")
    scaled = segments.scale_features(df)
    got = np.array([[r[c] for c in segments.SCALED_COLUMNS] for r in scaled.collect()])
    logs = np.log1p(np.array([[1, 3, 10], [5, 3, 100], [50, 3, 4000]], dtype=float))
    expected = (logs - logs.mean(0)) / np.where(logs.std(0) > 0, logs.std(0), 1)
    assert np.allclose(got, expected)
    assert (got[:, 1] == 0).all()


def test_names_follow_recency_then_spend(spark):
    profile = spark.createDataFrame(
        [(0, 300.0, 1.0, 10.0), (1, 20.0, 9.0, 500.0), (2, 10.0, 2.0, 100.0), (3, 200.0, 5.0, 90.0)], PROFILE)
    names = {r["cluster"]: r["segment"] for r in segments.name_segments(profile).collect()}
    assert names == {1: "Champions", 2: "Promising", 3: "At risk", 0: "Lost"}


def test_names_need_four_clusters(spark):
    profile = spark.createDataFrame([(0, 1.0, 1.0, 1.0), (1, 2.0, 1.0, 1.0)], PROFILE)
    with pytest.raises(PySparkException, match="exactly 4"):
        segments.name_segments(profile).collect()


def _four_groups(spark):
    """Customers in four clear groups, the group is customer_id % 4."""
    group = F.col("id") % 4
    spread = 1 + (F.col("id") % 7) / 100.0
    def pick(*values):
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (group + 1).cast("int"))

    return spark.range(400).select(
        F.col("id").alias("customer_id"),
        (pick(5, 8, 300, 500) * spread).alias("recency_days"),
        (pick(30, 3, 6, 1) * spread).alias("frequency"),
        (pick(20000, 400, 2000, 50) * spread).alias("monetary"))


def test_kmeans_finds_and_names_clear_groups(spark):
    scaled = segments.scale_features(_four_groups(spark))
    model = segments.fit_segments(scaled, n_init=4)
    named = segments.assign_segments(model.transform(segments._vectors(scaled)).drop("vector"))
    got = {(r["customer_id"] % 4, r["segment"]) for r in named.collect()}
    assert got == {(0, "Champions"), (1, "Promising"), (2, "At risk"), (3, "Lost")}
    assert named.columns == ["customer_id", "recency_days", "frequency", "monetary", "segment"]


def test_choose_k_prefers_the_true_number(spark):
    scaled = segments.scale_features(_four_groups(spark))
    rows = segments.choose_k(scaled, ks=(3, 4, 5), n_init=2).collect()
    assert [r["k"] for r in rows] == [3, 4, 5]
    assert rows[0]["inertia"] > rows[1]["inertia"]
    assert max(rows, key=lambda r: r["silhouette"])["k"] == 4


def test_summary_shares_divide_rounded_totals(spark):
    df = spark.createDataFrame(
        [(1, 10, 1, 0.25, "A"), (2, 20, 2, 0.10, "A"), (3, 30, 3, 0.35, "B"), (4, 1, 1, 9.0, None)],
        "customer_id long, recency_days int, frequency long, monetary double, segment string")
    rows = {r["segment"]: r for r in segments.segment_summary(df).collect()}
    assert set(rows) == {"A", "B"}
    # 0.35 rounds to 0.4 (half to even) and 0.35 again: shares of 0.4 + 0.4
    assert rows["A"]["total_revenue"] == rows["B"]["total_revenue"] == 0.4
    assert rows["A"]["revenue_share"] == 0.5
    assert rows["A"]["avg_recency_days"] == 15.0 and rows["A"]["customers"] == 2


def test_shares_add_up_to_one(spark, sf_dir):
    rows = segments.segment_shares(over_folder(spark, sf_dir).segments).collect()
    assert math.isclose(sum(r["customer_share"] for r in rows), 1)
    assert math.isclose(sum(r["revenue_share"] for r in rows), 1)
    assert [r["revenue_share"] for r in rows] == sorted(r["revenue_share"] for r in rows)


def test_duplicates_are_found(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "customer_id long")
    assert [tuple(r) for r in segments.duplicated_customers(df).collect()] == [(1, 2)]


def test_nearest_centre_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "a double, b double, c double")
    got = segments.nearest_centre(df, [(2, 0, 0), (1, 0, 0), (0, 1, 0)], ("a", "b", "c"))
    assert got.first()["cluster"] == 1
