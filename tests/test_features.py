import pytest
from pyspark.sql import functions as F

import frames
from cartwise.operators import cleaning, features
from cartwise.plans.registry import over_folder
from cartwise.schemas import FEATURE_COLUMNS

CUTOFF = "2011-06-01"
OWN_CUTOFF = "2019-03-16"


@pytest.fixture(scope="module")
def purchases(spark):
    """Customer 10 buys before, on and after the cutoff, 20 only long before, 30 only after."""
    return frames.purchases(spark, [
        (10, "P1", "2018-03-16", 12.5),
        (10, "P2", "2019-03-15", 7.5),
        (10, "P2", "2019-03-15", 2.0),
        (10, "P3", "2019-03-16", 400.0),
        (20, "Q1", "2018-12-16", 64.0),
        (20, "Q2", "2018-12-15", 16.0),
        (30, "R1", "2019-06-14", 5.0),
    ])


@pytest.fixture(scope="module")
def cancelled(spark):
    return frames.cancellations(spark, [
        (20, "C7", "2019-01-05"), (20, "C8", "2019-01-06"), (20, "C8", "2019-01-06"),
        (20, "C9", "2019-03-16"), (30, "C1", "2019-01-01")])


def test_features_of_each_customer(purchases, cancelled):
    rows = frames.by_customer(features.build_features(purchases, cancelled, OWN_CUTOFF))
    assert set(rows) == {10, 20}
    wanted = {
        10: dict(recency_days=1, frequency=2, monetary=22.0, avg_order_value=11.0, tenure_days=365,
                 orders_last_90d=1.0, cancel_rate=0.0),
        20: dict(recency_days=90, frequency=2, monetary=80.0, avg_order_value=40.0, tenure_days=91,
                 orders_last_90d=1.0, cancel_rate=1.0),
    }
    for customer, values in wanted.items():
        assert {c: rows[customer][c] for c in values} == values


def test_later_lines_change_nothing(purchases, cancelled):
    early = F.col("invoice_date") < F.lit(OWN_CUTOFF).cast("timestamp_ntz")
    both = (features.build_features(purchases, cancelled, OWN_CUTOFF),
            features.build_features(purchases.where(early), cancelled.where(early), OWN_CUTOFF))
    assert both[0].exceptAll(both[1]).count() == both[1].exceptAll(both[0]).count() == 0


def test_label_counts_purchases_on_the_cutoff_and_in_90_days_after(spark, purchases):
    customers = spark.createDataFrame([(10,), (20,), (30,)], "customer_id long")
    rows = frames.by_customer(features.build_labels(purchases, customers, OWN_CUTOFF))
    assert {c: r["churned"] for c, r in rows.items()} == {10: 0, 20: 1, 30: 1}


def test_schema_and_column_order(purchases, cancelled):
    df = features.build_features(purchases, cancelled, CUTOFF)
    assert df.columns == ["customer_id", *FEATURE_COLUMNS]
    kinds = dict(df.dtypes)
    assert kinds["recency_days"] == kinds["frequency"] == kinds["distinct_products"] == "bigint"
    assert kinds["orders_last_90d"] == kinds["cancel_rate"] == "double"
    assert kinds["is_uk"] == "int"


def test_window_boundaries(spark):
    rows = frames.purchases(spark, [
        (1, "A", "2011-03-03 00:00:00", 1.0),   # exactly 90 days before: recent
        (2, "B", "2011-03-02 23:59:59", 1.0),   # one second earlier: not recent
        (3, "C", "2011-05-01", 1.0), (3, "D", "2011-06-01 00:00:00", 7.0),   # at the cutoff: label
        (4, "E", "2011-05-01", 1.0), (4, "F", "2011-08-30 00:00:00", 7.0),   # at its end: neither
        (5, "G", "2011-06-01", 1.0),            # nothing before the cutoff: absent
        (6, "H", "2010-06-01 00:00:00", 1.0),   # 365 days: eligible
        (7, "I", "2010-05-31 23:59:59", 1.0),   # 365 days and a second: 365 whole days
        (8, "J", "2010-05-31 00:00:00", 1.0),   # 366 days: not eligible
    ])
    none = frames.cancellations(spark, [])
    lines = features.activity_of(rows, none)
    got = frames.by_customer(features.features_as_of(lines, CUTOFF))
    assert (got[1]["orders_last_90d"], got[2]["orders_last_90d"]) == (1.0, 0.0)
    assert got[3]["monetary"] == 1.0 and 5 not in got
    trained = frames.by_customer(features.training_set(lines, CUTOFF))
    assert trained[3]["churned"] == 0 and trained[4]["churned"] == 1
    assert sorted(trained) == [1, 2, 3, 4, 6, 7]
    labels = frames.by_customer(features.build_labels(rows, rows.select("customer_id").distinct(), CUTOFF))
    assert labels[3]["churned"] == 0 and labels[4]["churned"] == 1


def test_elapsed_days_are_not_calendar_days(spark):
    rows = frames.purchases(spark, [(1, "A", "2011-05-31 10:00:00", 1.0)])
    got = frames.by_customer(features.build_features(rows, frames.cancellations(spark, []), CUTOFF))
    assert got[1]["recency_days"] == 0


def test_elapsed_days_over_a_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = frames.purchases(spark, [(1, "A", "2011-03-01 00:30:00", 1.0)])
        got = frames.by_customer(
            features.build_features(rows, frames.cancellations(spark, []), "2011-03-31 00:30:00"))
        assert got[1]["recency_days"] == 30
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_order_that_spans_the_cutoff_is_cut(spark):
    rows = frames.purchases(spark, [
        (1, "A", "2011-05-31 23:00:00", 10.0), (1, "A", "2011-06-01 01:00:00", 90.0)])
    got = frames.by_customer(features.build_features(rows, frames.cancellations(spark, []), CUTOFF))
    assert got[1]["monetary"] == 10.0 and got[1]["frequency"] == 1


def test_main_country_is_counted_over_lines_and_ties_go_to_the_first_name(spark):
    home = "United Kingdom"
    rows = frames.purchases(spark, [
        (1, "A", "2011-01-01", 1.0, "X", "France"), (1, "B", "2011-01-02", 1.0, "X", home),  # tie
        (2, "A2", "2011-01-01", 1.0, "X", "Zimbabwe"), (2, "B2", "2011-01-02", 1.0, "X", home),  # tie
        (3, "A3", "2011-01-01", 1.0, "X", home), (3, "A3", "2011-01-01", 1.0, "Y", home),
        (3, "B3", "2011-01-02", 1.0, "X", "France"),
        (4, "A4", "2011-01-01", 1.0, "X", None),
    ])
    countries = frames.by_customer(features.main_country(rows))
    assert [countries[i]["country"] for i in (1, 2, 3)] == ["France", home, home]
    got = frames.by_customer(features.build_features(rows, frames.cancellations(spark, []), CUTOFF))
    assert [got[i]["is_uk"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert got[3]["distinct_products"] == 2


def test_cancel_rate_can_exceed_one_and_needs_a_purchase(spark):
    rows = frames.purchases(spark, [(1, "A", "2011-01-01", 1.0)])
    cancelled = frames.cancellations(spark, [
        (1, "C1", "2011-01-02"), (1, "C2", "2011-01-02"), (1, "C2", "2011-01-03"),
        (1, "C9", "2011-06-01"), (2, "C3", "2011-01-02")])
    got = frames.by_customer(features.build_features(rows, cancelled, CUTOFF))
    assert got[1]["cancel_rate"] == 2.0 and 2 not in got


def test_nothing_leaks_from_after_the_cutoff(spark, sf_dir):
    retail = over_folder(spark, sf_dir)
    def table(lines):
        df = features.features_as_of(lines, retail.cutoff, "NATION_11")
        return df.withColumns({c: F.round(c, 4) for c in ("monetary", "avg_order_value")})

    past = retail.activity.where(F.col("invoice_date") < F.lit(str(retail.cutoff)).cast("timestamp_ntz"))
    everything, only_past = table(retail.activity), table(past)
    assert everything.exceptAll(only_past).count() == only_past.exceptAll(everything).count() == 0
    assert everything.count() > 0


def test_one_pass_equals_features_plus_labels(spark, sf_dir):
    retail = over_folder(spark, sf_dir)
    purchases, cancelled = retail.clean, cleaning.cancellations(retail.raw)
    built = features.eligible(
        features.build_features(purchases, cancelled, retail.cutoff, "NATION_11"))
    labelled = built.join(features.build_labels(purchases, built, retail.cutoff), "customer_id")
    digits = {c: F.round(c, 4) for c in ("monetary", "avg_order_value")}
    one, two = retail.training.withColumns(digits), labelled.withColumns(digits)
    assert one.columns == two.columns
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_reference_dates_come_from_purchases_only(spark):
    rows = frames.purchases(spark, [(1, "A", "2011-12-09 12:50:00", 1.0)])
    got = features.reference_dates(rows).first()
    assert str(got["data_end"]) == "2011-12-10 00:00:00"
    assert str(got["cutoff"]) == "2011-09-11 00:00:00"
    assert features.training_cutoff(rows) == got["cutoff"]


def test_last_purchase_is_found_from_the_end_or_by_a_full_search(spark):
    late = ("C9", "A", "a", -1, "2011-12-31 10:00:00", 1.0, 1, "X")
    near = ("1", "A", "a", 1, "2011-12-09 12:50:00", 1.0, 1, "X")
    far = ("2", "A", "a", 1, "2011-03-01 12:50:00", 1.0, 1, "X")
    for rows, expected in (([late, near, far], "2011-12-10 00:00:00"), ([late, far], "2011-03-02 00:00:00"),
                           ([late], "None"), ([], "None")):
        raw = frames.raw(spark, rows)
        assert str(features.data_end(cleaning.clean_transactions(raw), raw)) == expected


def test_empty_input(spark):
    nothing = frames.purchases(spark, []), frames.cancellations(spark, [])
    assert features.build_features(*nothing, CUTOFF).count() == 0
    assert features.data_end(nothing[0]) is None


def test_hot_customer(spark):
    """A customer with most of the lines: the counts stay whole."""
    lines = spark.range(20000).select(
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).cast("long").alias("customer_id"),
        F.concat(F.lit("I"), (F.col("id") / 4).cast("int")).alias("invoice"),
        F.lit("2011-01-01").cast("timestamp_ntz").alias("invoice_date"),
        F.lit(1.0).alias("line_total"),
        F.concat(F.lit("P"), F.col("id") % 3000).alias("stock_code"),
        F.lit("United Kingdom").alias("country"))
    got = frames.by_customer(
        features.build_features(lines, frames.cancellations(spark, []), CUTOFF).where("customer_id = 1"))
    expected = lines.where("customer_id = 1").agg(
        F.count_distinct("invoice"), F.sum("line_total"), F.count_distinct("stock_code")).first()
    assert (got[1]["frequency"], got[1]["monetary"], got[1]["distinct_products"]) == tuple(expected)
