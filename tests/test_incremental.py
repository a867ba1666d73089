import random
from datetime import date

import pytest
from pyspark.sql import functions as F

import frames
from cartwise.operators import cleaning, exploration, facts, features, reporting
from cartwise.plans.registry import HOME, over_folder
from cartwise.schemas import RAW_TRANSACTIONS
from cartwise.sources import files, incremental


def raw_lines(n, seed=0):
    own = random.Random(seed)
    out = []
    for _ in range(n):
        cancelled = own.random() < 0.15
        out.append((("C" if cancelled else "") + str(own.randrange(60)), own.choice(["A", "B", "POST", "7", None]),
                    own.choice(["x", None]), -3 if cancelled else own.randrange(1, 9),
                    f"2011-{own.randrange(1, 9):02d}-{own.randrange(1, 28):02d} 1{own.randrange(10)}:00:00",
                    float(own.randrange(1, 9)), own.choice([None, *range(12)]), own.choice(["United Kingdom", "France", "Albania"])))
    return out


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.mark.parametrize("compact", [False, True])
def test_facts_of_batches_give_the_features_of_all_lines(spark, compact):
    lines = features.activity(frames.raw(spark, raw_lines(1500)))
    name = f"facts_{compact}"
    for part in range(4):
        facts.add_batch(lines.where(F.pmod(F.xxhash64("invoice", "stock_code"), F.lit(4)) == part), name)
    if compact:
        before = spark.table(name).count()
        facts.compact(spark, name)
        assert spark.table(name).count() < before
    table = spark.table(name)
    assert same(facts.added_up(table), facts.added_up(facts.facts_of(lines)))
    for cutoff in ("2011-05-01", "2011-02-10 13:00:00", "2012-01-01", "2010-01-01"):
        assert same(facts.features_from(table, cutoff), features.features_as_of(lines, cutoff))
        assert same(facts.training_set_from(table, cutoff), features.training_set(lines, cutoff))
    spark.sql(f"DROP TABLE {name}")


def test_a_batch_reads_no_old_line(spark):
    lines = features.activity(frames.raw(spark, raw_lines(50)))
    plan = facts.facts_of(lines)._jdf.queryExecution().toString()
    assert "fact" not in plan.split("== Physical Plan ==")[1].lower()


def test_append_of_an_overlapping_period(spark):
    rows = raw_lines(900, seed=2)
    odd = [(None, None, None, None, None, None, None, None), ("1", "A", None, 1, None, 1.0, 5, "France")]
    first, second = rows[:600] + odd, rows[400:] + rows[400:450] + odd
    name = "base_overlap"
    incremental.create_filtered_table(frames.raw(spark, first).dropDuplicates(), name)
    added = incremental.append_new_lines(frames.raw(spark, second), name)
    whole = frames.raw(spark, first + second).to(RAW_TRANSACTIONS).dropDuplicates()
    assert same(spark.table(name), whole) and added == whole.count() - len(set(first))
    assert incremental.append_new_lines(frames.raw(spark, second), name) == 0
    late = [("900", "A", None, 2, "2015-03-03 10:00:00", 1.0, 5, "France")]
    assert incremental.append_new_lines(frames.raw(spark, late * 3), name) == 1
    assert incremental.append_new_lines(frames.raw(spark, late + rows), name) == 0
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {incremental.filter_name(name)}")


def test_the_filter_knows_every_line_and_few_others(spark):
    lines = frames.raw(spark, raw_lines(4000, seed=3)).to(RAW_TRANSACTIONS).dropDuplicates()
    keyed = incremental._keyed(lines)
    known = incremental._words(keyed, incremental._sizes(keyed))
    assert incremental.candidates(keyed, known).where("NOT maybe").count() == 0
    others = incremental._keyed(lines.withColumn("price", F.col("price") + 0.5))
    share = incremental.candidates(others, known).agg(F.avg(F.col("maybe").cast("double"))).first()[0]
    assert share < 0.08
    assert known.count() < lines.count() / 4


def test_words_of_lines_move_no_line(spark):
    """Months are few: the lines are not dealt out by month to learn the size of their filter."""
    keyed = incremental._keyed(frames.raw(spark, raw_lines(50)).to(RAW_TRANSACTIONS))
    plan = incremental._words(keyed, incremental._sizes(keyed))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_only_candidates_and_checked_lines_are_written(spark, monkeypatch):
    name, rows = "base_written", raw_lines(300, seed=8)
    incremental.create_filtered_table(frames.raw(spark, rows).dropDuplicates(), name)
    kept = {}

    def written(df, what):
        kept[what] = incremental_written(df, what)
        return kept[what]

    incremental_written = incremental.written
    monkeypatch.setattr(incremental, "written", written)
    more = [("9000", "A", None, 2, f"2011-03-03 10:00:{i:02d}", 1.0, 5, "France") for i in range(40)]
    assert incremental.append_new_lines(frames.raw(spark, more), name) == 40
    assert kept["late"].count() < 20 and not {"digest", "mask"} & set(kept["checked"].columns)
    assert spark.table(name).count() == len(set(rows)) + 40
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {incremental.filter_name(name)}")


def test_only_months_of_candidates_are_read(spark):
    name = "base_pruned"
    rows = [(str(i), "A", "x", 1, f"2011-{1 + i % 12:02d}-05 10:00:00", 1.0, i, "France") for i in range(240)]
    incremental.create_filtered_table(frames.raw(spark, rows), name)
    march = incremental._keyed(frames.raw(spark, rows).to(RAW_TRANSACTIONS).where("month(invoice_date) = 3"))
    found = incremental.candidates(march, spark.table(incremental.filter_name(name))).where("maybe")
    plan = incremental.not_there(found, spark.table(name))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(invoice_date), GreaterThanOrEqual(invoice_date,2011-03-01T00:00)" in plan or (
        "GreaterThanOrEqual(invoice_date,2011-03-01T00:00)" in plan and "LessThan(invoice_date,2011-04-01T00:00)" in plan)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {incremental.filter_name(name)}")


def test_months_next_to_each_other_are_one_range(spark):
    condition = incremental.in_months(["2011-01", "2011-02", "2011-12", "2012-01", ""])._jc.toString()
    assert condition.count("2011-01-01") == condition.count("2011-03-01") == 1
    assert condition.count("2011-12-01") == condition.count("2012-02-01") == 1 and "isNull" in condition


def test_publish_from_the_table_itself(spark):
    spark.range(10).write.mode("overwrite").saveAsTable("published_self")
    files.publish(spark.table("published_self").where("id < 4"), "published_self")
    assert sorted(r.id for r in spark.table("published_self").collect()) == [0, 1, 2, 3]
    assert files.taken("published_self", spark).count() == 4
    assert not spark.catalog.tableExists("published_self")


def test_cube_answers_every_choice_of_slicers(spark, sf_dir):
    import itertools
    scores = over_folder(spark, sf_dir).scores.persist()
    cube = reporting.risk_cube(scores).persist()
    assert cube.count() < 200
    segments = [None, ("Champions",), ("At risk", "Lost")]
    risks = [None, ("High",), ("Low", "Medium"), ("Low", "High")]

    def rounded(df):
        return {tuple(None if v is None else round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()}

    for chosen, risk in itertools.product(segments, risks):
        for by in ((), ("segment",)):
            assert rounded(reporting.cube_measures(cube, by, chosen, risk)) == rounded(
                reporting.risk_measures(scores, by, chosen, risk))
    scores.unpersist()


def test_bitmaps_of_any_months_count_as_the_lines_do(spark):
    clean = cleaning.clean_transactions(frames.raw(spark, raw_lines(1200, seed=5) + [
        (f"N{i}", "A", "x", 1, "2011-03-03 10:00:00", 1.0, 40_000 * i, "France") for i in range(5)]))
    rollup = exploration.sales_rollup(clean).persist()
    for low, high in (("2011-01-01", "2011-03-01"), ("2011-03-01", "2011-03-01"), ("2011-02-01", "2011-08-01")):
        months = F.col("month").between(low, high)
        want = clean.withColumn("month", F.trunc(F.to_date("invoice_date"), "month")).where(months).groupBy("country").agg(
            F.count_distinct("customer_id").alias("customers"), F.count_distinct("invoice").alias("orders"),
            F.sum(F.col("line_total").cast("decimal(28,6)")).cast("double").alias("revenue"))
        got = exploration.distinct_sales(rollup.where(months), ("country",)).withColumn(
            "revenue", F.col("revenue").cast("double"))
        assert same(got, want)
    rollup.unpersist()


def test_bitmaps_take_no_more_room_than_their_numbers(spark):
    """Numbers far apart: a bitmap of 32,768 of them would take 4 KB for each."""
    clean = cleaning.clean_transactions(frames.raw(spark, [
        (str(1_000_000 * i), "A", "x", 1, "2011-03-03 10:00:00", 1.0, 70_000 * i, "France") for i in range(1, 30)]))
    rollup = exploration.sales_rollup(clean)
    assert dict(rollup.dtypes)["bits"] == "bigint" and rollup.count() == 58
    assert "SortAggregate" not in rollup._jdf.queryExecution().executedPlan().toString()
    assert exploration.rolling_sales(rollup).first().asDict() | {"revenue": 0} == {
        "until": date(2011, 3, 1), "customers": 29, "orders": 29, "revenue": 0}


def test_two_way_order_serves_both_filters(spark):
    own = random.Random(1)
    rows = [(str(i), "A", "x", 1, f"20{10 + own.randrange(4)}-{own.randrange(1, 13):02d}-{own.randrange(1, 28):02d} 10:00:00",
             1.0, own.choice([None, *range(1000, 6000)]), "France") for i in range(6000)]
    lines, name = frames.raw(spark, rows), "base_two_way"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data in many files
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        files.create_two_way_table(lines, name)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    table = spark.table(name)
    assert same(table, lines.to(RAW_TRANSACTIONS))
    dates = files.files_that_may_hold(table, F.col("invoice_date").cast("string"), "2011-03-01", "2011-03-31").first()
    customers = files.files_that_may_hold(table, "customer_id", 4000, 4010).first()
    assert dates.files > 50 and dates.reached < dates.files * 0.35 and customers.reached < customers.files * 0.35
    spark.sql(f"DROP TABLE {name}")


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    for r in rows.withColumn("z", files.interleaved(F.col("a"), F.col("b"), 3)).collect():
        assert r.z == sum((r.a >> i & 1) << 2 * i + 1 | (r.b >> i & 1) << 2 * i for i in range(3))


def test_two_way_table_of_no_or_equal_lines(spark):
    for rows in ([], [("1", "A", "x", 1, "2011-01-01 10:00:00", 1.0, None, "France")] * 3):
        files.create_two_way_table(frames.raw(spark, rows), "base_odd")
        assert spark.table("base_odd").count() == len(rows)
    spark.sql("DROP TABLE base_odd")
