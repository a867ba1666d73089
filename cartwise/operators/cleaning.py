"""Cleaning views over the raw invoice lines."""
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..schemas import EXCLUDED_CODES

CLEAN_COLUMNS = ("invoice", "stock_code", "description", "quantity", "invoice_date",
                 "price", "line_total", "customer_id", "country")


def is_cancellation():
    return F.col("customer_id").isNotNull() & F.col("invoice").startswith("C")


def is_purchase(excluded_codes=EXCLUDED_CODES):
    """Attributable purchase. A null in any tested column fails the test."""
    return (
        F.col("customer_id").isNotNull()
        & ~F.col("invoice").startswith("C")
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
        & ~F.col("stock_code").isin(*excluded_codes)
    )


def with_line_total(lines):
    return lines.withColumn("line_total", F.col("quantity") * F.col("price"))


def clean_transactions(raw, excluded_codes=EXCLUDED_CODES):
    return with_line_total(raw.where(is_purchase(excluded_codes))).select(*CLEAN_COLUMNS)


def cancellations(raw):
    return raw.where(is_cancellation()).select(
        "invoice", "stock_code", "quantity", "invoice_date", "price", "customer_id")


def create_views(raw):
    """Register both views, so that SQL users can query them by name."""
    clean_transactions(raw).createOrReplaceTempView("clean_transactions")
    cancellations(raw).createOrReplaceTempView("cancellations")


def cleaning_summary(raw, excluded_codes=EXCLUDED_CODES):
    """How much data survives cleaning: one scan, one row."""
    purchase = is_purchase(excluded_codes)
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(purchase).alias("clean_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("rows_without_customer"),
        F.count_distinct(F.when(purchase, F.col("customer_id"))).alias("customers"),
    )


def cancelled_invoice_share(raw):
    """Percent of invoices that are cancellations.

    Invoices are made distinct first, so both counts come from the same shuffle.
    """
    invoices = raw.where(F.col("invoice").isNotNull()).select("invoice").distinct()
    share = ratio(100 * F.count_if(F.col("invoice").startswith("C")), F.count(F.lit(1)))
    return invoices.agg(F.round(share, 2).alias("pct_cancelled_invoices"))
