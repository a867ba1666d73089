"""Exploratory sales questions over the clean purchases."""
from pyspark.sql import Window, functions as F

from ..functions.columns import exact_sum, month_start, round_half_up


def monthly_revenue(clean, digits=0):
    """Revenue, active customers and orders per month; digits=None leaves the exact revenue.

    Lines are first added up per (month, customer, invoice), so the distinct counts run over
    orders and no line is multiplied for them.
    """
    orders = clean.groupBy(month_start("invoice_date").alias("month"), "customer_id", "invoice").agg(
        exact_sum("line_total").alias("order_total"))
    months = orders.groupBy("month").agg(
        F.sum("order_total").alias("revenue"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.count_distinct("invoice").alias("orders"),
    )
    if digits is not None:
        months = months.withColumn("revenue", round_half_up("revenue", digits))
    return months.orderBy("month")


def sales_rollup(clean):
    """Mergeable sales per (month, country): revenue, and who bought and which orders as bitmaps.

    Rows (month, country, kind, bucket, name, bits, revenue): the bits of a long stand for 64 consecutive
    numbers of customers or orders. So short a bitmap takes no more room than the numbers in it where these
    lie far apart, and is a buffer that a hash aggregate changes in place. An order whose name is no number is
    a row of its own. Unlike counts of distinct customers, bitmaps of several months or countries can be put
    together without reading the lines again.
    """
    number = F.col("invoice").try_cast("bigint")
    lines = clean.select(
        month_start("invoice_date").alias("month"), "country", "line_total", F.stack(
            F.lit(2), F.lit("customer"), F.col("customer_id"), F.lit(None).cast("string"),
            F.lit("order"), number, F.when(number.isNull(), F.col("invoice"))).alias("kind", "number", "name"))
    place = F.coalesce("number", F.lit(0)).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return (lines.groupBy("month", "country", "kind", F.shiftright("number", 6).alias("bucket"), "name")
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("bits"),
                 exact_sum(F.when(F.col("kind") == "order", F.col("line_total"))).alias("revenue")))


def _merged(rollup, by):
    return rollup.groupBy(*by, "kind", "bucket", "name").agg(
        F.bit_or("bits").alias("bits"), F.sum("revenue").alias("revenue"))


def distinct_sales(rollup, by=()):
    """Customers, orders and revenue of the rolled-up rows, each customer and order once per group."""
    def distinct(kind):
        return F.sum(F.when(F.col("kind") == kind, F.bit_count("bits")).otherwise(0))

    return _merged(rollup, by).groupBy(*by).agg(
        distinct("customer").alias("customers"), distinct("order").alias("orders"), F.sum("revenue").alias("revenue"))


def rolling_sales(rollup, months=3):
    """Customers, orders and revenue of the `months` months that end with each month."""
    # Countries are put together first, so that fewer rows are repeated for the months that follow.
    ends = _merged(rollup, ("month",)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("later")).withColumn(
        "until", F.add_months("month", F.col("later")))
    # The last month reaches months - 1 further; the window runs over one row per month.
    last = F.add_months(F.max("until").over(Window.partitionBy()), 1 - months)
    found = distinct_sales(ends, ("until",)).withColumn("last", last)
    return found.where(F.col("until") <= F.col("last")).drop("last")


def revenue_by_country(clean):
    """Customers and exact revenue per country, added up per customer first."""
    customers = clean.groupBy("country", "customer_id").agg(exact_sum("line_total").alias("spend"))
    return customers.groupBy("country").agg(
        F.count("customer_id").alias("customers"), F.sum("spend").alias("revenue"))


def top_countries(clean, n=10):
    """Countries with the highest rounded revenue; equal revenues in name order."""
    return (
        revenue_by_country(clean)
        .withColumn("revenue", round_half_up("revenue"))
        .orderBy(F.desc("revenue"), "country")
        .limit(n)
    )


def country_revenue_share(clean, n=10):
    """Top countries with their share of the revenue of all countries.

    The total is summed over the aggregated countries (a few hundred rows at most),
    so the lines are read once.
    """
    everywhere = Window.partitionBy()
    return (
        revenue_by_country(clean)
        .withColumn("revenue", F.col("revenue").cast("double"))
        .withColumn("revenue_share", F.try_divide("revenue", F.sum("revenue").over(everywhere)))
        .orderBy(F.desc("revenue"), "country")
        .limit(n)
    )


def top_products(clean, n=10):
    """Products with the most units.

    Lines are first added up per (code, description): numeric buffers keep that step a
    hash aggregate, and the maximum text is then taken over the few distinct pairs.
    """
    pairs = clean.groupBy("stock_code", "description").agg(F.sum("quantity").alias("units"))
    return (
        pairs.groupBy("stock_code")
        .agg(F.max("description").alias("description"), F.sum("units").alias("units"))
        .orderBy(F.desc("units"), "stock_code")
        .limit(n)
    )


def orders_per_customer(clean):
    invoices = clean.select("customer_id", "invoice").distinct()
    return invoices.groupBy("customer_id").agg(F.count("invoice").alias("orders"))


def order_count_distribution(clean, n=15):
    """Customers by number of orders, the n smallest numbers of orders."""
    return (
        orders_per_customer(clean)
        .groupBy("orders").agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("orders")
        .limit(n)
    )


def order_count_clipped(clean, top=10):
    """Customers by number of orders, with `top` and more in one labelled bucket."""
    orders = F.least("orders", F.lit(top)).cast("long")
    return (
        orders_per_customer(clean)
        .groupBy(orders.alias("orders")).agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("label", F.when(F.col("orders") < top, F.col("orders").cast("string"))
                    .otherwise(f"{top}+"))
        .orderBy("orders")
    )


def single_order_share(clean):
    single = (F.col("orders") == 1).cast("double")
    return orders_per_customer(clean).agg(F.avg(single).alias("single_order_share"))
