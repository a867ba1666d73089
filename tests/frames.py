"""Small hand-made tables."""
from pyspark.sql import functions as F

PURCHASES = ("customer_id long, invoice string, invoice_date string, line_total double, "
             "stock_code string, country string")
CANCELLED = "customer_id long, invoice string, invoice_date string"
RAW = ("invoice string, stock_code string, description string, quantity int, invoice_date string, "
       "price double, customer_id long, country string")


def _timed(df):
    return df.withColumn("invoice_date", F.col("invoice_date").cast("timestamp_ntz"))


def purchases(spark, rows):
    """Rows of (customer, invoice, date, total[, code[, country]])."""
    full = [(*r, *("X", "United Kingdom")[len(r) - 4:]) if len(r) < 6 else r for r in rows]
    return _timed(spark.createDataFrame(full, PURCHASES))


def cancellations(spark, rows):
    return _timed(spark.createDataFrame(rows, CANCELLED))


def raw(spark, rows):
    return _timed(spark.createDataFrame(rows, RAW))


def by_customer(df):
    return {row["customer_id"]: row for row in df.collect()}
