import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import frames
from cartwise import schemas, staging
from cartwise.sources import files

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def write(tmp_path, name, *lines, header=HEADER):
    path = tmp_path / name
    path.write_text(header + "".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_csv_types_and_missing_values(spark, tmp_path):
    path = write(tmp_path, "a.csv",
                 "489434,85048,\"12\"\" GLASS, BALL\",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom",
                 "489435,M,NULL,,2009-12-01 07:46:00,NA,,nan")
    rows, bad = files.read_transactions_csv(spark, [path])
    assert rows.schema.simpleString() == schemas.RAW_TRANSACTIONS.simpleString()
    first, second = sorted(rows.collect(), key=lambda r: r["invoice"])
    assert first["description"] == '12" GLASS, BALL' and first["customer_id"] == 13085
    assert str(first["invoice_date"]) == "2009-12-01 07:45:00"
    assert tuple(second[c] for c in ("description", "quantity", "price", "customer_id", "country")) \
        == (None,) * 5
    assert bad.count() == 0


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = write(tmp_path, "a.csv",
                 "1,A,d,1,2009-12-01 07:45:00,1.0,1,X",
                 "2,A,d,one,2009-12-01 07:45:00,1.0,1,X",
                 "3,A,d,1,yesterday,1.0,1,X")
    rows, bad = files.read_transactions_csv(spark, [path])
    assert [r["invoice"] for r in rows.collect()] == ["1"]
    assert sorted((r["Invoice"], r["failed_columns"]) for r in bad.collect()) == [
        ("2", ["Quantity"]), ("3", ["InvoiceDate"])]


def test_other_header_is_refused(spark, tmp_path):
    path = write(tmp_path, "a.csv", "A,1,d,1,2009-12-01 07:45:00,1.0,1,X",
                 header=HEADER.replace("Invoice,StockCode", "StockCode,Invoice"))
    with pytest.raises(Exception, match="header"):
        files.read_transactions_csv(spark, [path])[0].collect()


def test_large_and_fractional_ids(spark, tmp_path):
    path = write(tmp_path, "a.csv",
                 "1,A,d,1,2009-12-01 07:45:00,1.0,9007199254740993.0,X",
                 "2,A,d,1,2009-12-01 07:45:00,1.0,9007199254740992,X",
                 "3,A,d,1,2009-12-01 07:45:00,1.0,17.5,X")
    rows, bad = files.read_transactions_csv(spark, [path])
    assert sorted(r["customer_id"] for r in rows.collect()) == [9007199254740992, 9007199254740993]
    assert [(r["Invoice"], r["failed_columns"]) for r in bad.collect()] == [("3", ["Customer ID"])]


def test_parts_with_columns_in_another_order(spark, tmp_path):
    one = write(tmp_path, "1.csv", "1,A,d,1,2010-12-01 07:45:00,1.5,5,X")
    two = write(tmp_path, "2.csv", "X,1,A,d,1,2010-12-02 07:45:00,2.5,6",
                header="Country,Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID\n")
    same = write(tmp_path, "3.csv", "3,A,d,1,2010-12-03 07:45:00,3.5,7,X")
    parts, rejected = files.read_parts(spark, [one, two, same])
    assert len(parts) == 2 and rejected.count() == 0
    got = files.to_raw_transactions(files.merge_parts(parts)).collect()
    assert sorted((r["invoice"], r["price"], r["customer_id"], r["country"]) for r in got) == [
        ("1", 1.5, 5, "X"), ("1", 2.5, 6, "X"), ("3", 3.5, 7, "X")]
    other = write(tmp_path, "4.csv", "1,2", header="a,b\n")
    with pytest.raises(ValueError, match="header"):
        files.read_parts(spark, [other])


def test_quoted_line_breaks_as_an_option(spark, tmp_path):
    path = write(tmp_path, "a.csv", '1,A,"two\nlines",1,2010-12-01 07:45:00,1.0,5,X')
    rows, bad = files.read_transactions_csv(spark, [path], multi_line=True)
    assert [r["description"] for r in rows.collect()] == ["two\nlines"] and bad.count() == 0


def test_jdbc_reads_need_partitions_or_a_switch(spark):
    with pytest.raises(ValueError, match="single_task"):
        files.read_jdbc(spark, "jdbc:none", "SELECT 1")


def test_shared_folder_is_asked_for_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.own_folder("spark://somewhere:7077")
    for master in ("local", "local[8]", "local[*]"):
        assert staging.own_folder(master)


def test_parts_are_merged_without_copies(spark, tmp_path):
    line = "1,A,d,1,2010-12-01 07:45:00,1.0,,X"
    one = write(tmp_path, "1.csv", line, line, "2,A,d,1,2010-12-01 07:45:00,1.0,5,X")
    two = write(tmp_path, "2.csv", line, "3,A,d,1,2010-12-02 07:45:00,1.0,5,X")
    parts, rejected = files.read_parts(spark, [one, two])
    assert rejected.count() == 0
    merged, report = files.merge_parts_counted(parts)
    assert sorted(r["Invoice"] for r in merged.collect()) == ["1", "2", "3"]
    assert tuple(report.first()) == (5, 3, 2)
    assert tuple(files.duplicates_removed(parts).first()) == (5, 3, 2)
    assert files.merge_parts(parts).count() == 3


def test_parts_are_aligned_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert sorted(tuple(r) for r in files.merge_parts([a, b, c]).fillna("-").collect()) == [
        (1, "x"), (2, "y"), (3, "-")]


def test_ids_must_be_integral(spark):
    ids = spark.createDataFrame([(1234.0,), (None,), (float("nan"),)], "customer_id double")
    got = files.integral_ids(ids)
    assert got.dtypes == [("customer_id", "bigint")]
    assert sorted(r[0] or 0 for r in got.collect()) == [0, 0, 1234]
    exact = spark.createDataFrame([("9007199254740993.0",), ("9007199254740992",)], "customer_id string")
    assert [r[0] for r in files.integral_ids(exact).collect()] == [9007199254740993, 9007199254740992]
    broken = spark.createDataFrame([(1234.5,), (7.0,)], "customer_id double")
    assert [r[0] for r in files.fractional_ids(broken).collect()] == [1234.5]
    with pytest.raises(PySparkException, match="not integral"):
        files.integral_ids(broken).collect()


def test_a_hot_month_is_divided(spark):
    lines = frames.raw(spark, [("1", "A", "d", 1, "2011-01-01", 1.0, 1, "X")])
    many = spark.range(0, 60_000, 1, 8).crossJoin(lines).withColumn(
        "invoice_date", F.expr("timestampadd(SECOND, id % 1000, invoice_date)")).withColumn(
        "invoice", F.sha2(F.col("id").cast("string"), 256)).drop("id").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        files.create_base_table(many, "hot_t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert spark.table("hot_t").count() == 60_000 and len(spark.table("hot_t").inputFiles()) > 2


def test_base_table_create_and_append(spark):
    rows = frames.raw(spark, [("1", "A", "d", 1, "2011-01-01", 1.0, 1, "X")])
    files.create_base_table(rows, "base_t")
    shuffled = rows.select(*reversed(rows.columns)).withColumn("customer_id", F.col("customer_id").cast("int"))
    files.append_to_base_table(shuffled, "base_t")
    table = files.read_table(spark, "base_t")
    assert table.schema.simpleString() == schemas.RAW_TRANSACTIONS.simpleString()
    assert files.row_count(table).first()[0] == 2 and table.distinct().count() == 1
    files.create_base_table(rows, "base_t")
    assert files.row_count(files.read_table(spark, "base_t")).first()[0] == 1
    with pytest.raises(PySparkException):
        files.append_to_base_table(rows.drop("price").withColumn("price", F.lit("cheap")), "base_t")


def test_publish_replaces_schema_and_rows(spark):
    files.publish(spark.range(3), "published_t")
    files.publish(spark.createDataFrame([("a",)], "name string"), "published_t")
    assert spark.table("published_t").columns == ["name"]
    files.append_rows(spark.createDataFrame([("b",)], "name string"), "published_t")
    assert spark.table("published_t").count() == 2


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_feature_files(spark, tmp_path, file_format):
    row = (7, *[float(i) for i in range(9)])
    path = str(tmp_path / file_format)
    files.write_files(spark.createDataFrame([row], schemas.FEATURES), path, file_format)
    assert tuple(files.read_features(spark, path, file_format=file_format).first()) == row
