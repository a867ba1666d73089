"""Customer features as of a cutoff, and the forward-looking churn label.

One pass over the lines answers everything. Each line is turned into up to three facts
(its order, its product, its country), which are added up per (customer, kind, key) and
then per customer. Both steps use numeric buffers only, so they are partial + final hash
aggregates: a customer holding a large part of all lines is spread over many tasks in the
first step and reaches the second one already combined.
"""
from datetime import timedelta

from pyspark.sql import Window, functions as F

from ..functions.columns import as_time, days, elapsed_days, flag, midnight
from ..schemas import FEATURE_COLUMNS, HOME_COUNTRY, LABEL_DAYS, MAX_RECENCY_DAYS, RECENT_DAYS
from .cleaning import is_cancellation, is_purchase, with_line_total

ACTIVITY_COLUMNS = ("customer_id", "invoice", "invoice_date", "line_total", "stock_code", "country")

# Kinds of facts about a customer.
ORDER, PRODUCT, COUNTRY, CANCELLED, LATER = range(5)


def reference_dates(purchases, label_days=LABEL_DAYS):
    """One row: midnight after the last purchase, and the cutoff label_days before it."""
    last = purchases.agg(F.max("invoice_date").alias("last"))
    end = midnight("last") + days(1)
    return last.select(end.alias("data_end"), (end - days(label_days)).alias("cutoff"))


def data_end(purchases, raw=None, look_back=30):
    """The moment as a naive datetime. As a literal it can prune files and row groups.

    With the raw lines given, their last date (one column) tells where to look first: a
    purchase in the look_back days before it is the last one, and a table clustered by
    date reads only its end for that. Otherwise all purchases are searched.
    """
    if raw is not None:
        newest = raw.agg(F.max("invoice_date").alias("newest")).first()["newest"]
        recent = purchases.where(F.col("invoice_date") >= as_time(newest) - days(look_back))
        found = reference_dates(recent).first()["data_end"]
        if found is not None:
            return found
    return reference_dates(purchases).first()["data_end"]


def training_cutoff(purchases, label_days=LABEL_DAYS, raw=None):
    end = data_end(purchases, raw)
    return None if end is None else end - timedelta(days=label_days)


def activity(raw):
    """Attributable lines of the raw table, marked as purchase or not, from a single scan."""
    bought = is_purchase()
    return (
        with_line_total(raw.where(bought | is_cancellation()))
        .select(*ACTIVITY_COLUMNS, F.coalesce(bought, F.lit(False)).alias("is_purchase"))
    )


def activity_of(purchases, cancellations):
    """The same table from the two cleaned views."""
    bought = purchases.select(*ACTIVITY_COLUMNS, F.lit(True).alias("is_purchase"))
    cancelled = cancellations.select("customer_id", "invoice", "invoice_date",
                                     F.lit(False).alias("is_purchase"))
    return bought.unionByName(cancelled, allowMissingColumns=True)


def order_rollup(lines):
    """Lines to orders."""
    return lines.groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("order_date"),
        F.sum("line_total").alias("order_total"),
    )


def main_country(lines):
    """Most frequent country over the lines of a customer; of equals, the first by name."""
    counts = lines.where(F.col("country").isNotNull()).groupBy("customer_id", "country").count()
    first = Window.partitionBy("customer_id").orderBy(F.desc("count"), "country")
    return (
        counts.withColumn("place", F.row_number().over(first))
        .where(F.col("place") == 1)
        .select("customer_id", "country")
    )


def distinct_per_customer(lines, column, name):
    return lines.groupBy("customer_id").agg(F.count_distinct(column).alias(name))


def _facts(lines, cutoff, label_days):
    """Lines to (customer, kind, key) with first date, spend and number of lines."""
    before = F.col("invoice_date") < cutoff
    past_purchase = before & F.col("is_purchase")
    later_purchase = (
        (F.col("invoice_date") >= cutoff)
        & (F.col("invoice_date") < cutoff + days(label_days))
        & F.col("is_purchase")
    )
    kind = F.when(~before, LATER).when(F.col("is_purchase"), ORDER).otherwise(CANCELLED)
    key = F.when(before, F.col("invoice")).when(later_purchase, "")
    facts = lines.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "invoice_date", "line_total",
        F.stack(
            F.lit(3),
            kind, key,
            F.lit(PRODUCT), F.when(past_purchase, F.col("stock_code")),
            F.lit(COUNTRY), F.when(past_purchase, F.col("country")),
        ).alias("kind", "key"),
    )
    is_order = F.col("kind") == ORDER
    return facts.where(F.col("key").isNotNull()).groupBy("customer_id", "kind", "key").agg(
        F.min(F.when(is_order, F.col("invoice_date"))).alias("order_date"),
        F.sum(F.when(is_order, F.col("line_total"))).alias("order_total"),
        F.count(F.lit(1)).alias("lines"),
    )


def _customers(lines, cutoff, home_country, recent_days, label_days):
    return customers_of(_facts(lines, cutoff, label_days), cutoff, home_country, recent_days)


def customers_of(facts, cutoff, home_country, recent_days):
    """One row per customer with a purchase before the cutoff: features and label.

    The home country wins ties against names after it and loses them against names before it.
    """
    def aggregate(expression, name):
        return F.expr(expression).alias(name)

    facts = facts.withColumns({
        "recent": F.col("order_date") >= cutoff - days(recent_days),
        "home": F.when(F.col("key") == home_country, 0).when(F.col("key") < home_country, -1).otherwise(1),
    })
    customers = facts.groupBy("customer_id").agg(
        aggregate("min(order_date)", "first_order"),
        aggregate("max(order_date)", "last_order"),
        aggregate(f"count_if(kind = {ORDER})", "frequency"),
        aggregate("sum(order_total)", "monetary"),
        aggregate(f"double(count_if(kind = {ORDER} AND recent))", "orders_last_90d"),
        aggregate(f"count_if(kind = {PRODUCT})", "distinct_products"),
        aggregate(f"count_if(kind = {CANCELLED})", "cancelled"),
        aggregate(f"count_if(kind = {LATER})", "later"),
        aggregate(f"max(if(kind = {COUNTRY} AND home = 0, lines, 0))", "home_lines"),
        aggregate(f"max(if(kind = {COUNTRY} AND home < 0, lines, 0))", "lines_before"),
        aggregate(f"max(if(kind = {COUNTRY} AND home > 0, lines, 0))", "lines_after"),
    )
    return customers.where("frequency > 0").select(
        "customer_id",
        elapsed_days("last_order", cutoff).alias("recency_days"),
        "frequency",
        "monetary",
        aggregate("monetary / frequency", "avg_order_value"),
        elapsed_days("first_order", cutoff).alias("tenure_days"),
        "distinct_products",
        "orders_last_90d",
        aggregate("cancelled / double(frequency)", "cancel_rate"),
        aggregate("int(home_lines > lines_before AND home_lines >= lines_after)", "is_uk"),
        aggregate("int(later = 0)", "churned"),
    )


def features_as_of(lines, cutoff, home_country=HOME_COUNTRY, recent_days=RECENT_DAYS):
    """The nine features from an activity table. Nothing at or after the cutoff is used."""
    past = lines.where(F.col("invoice_date") < as_time(cutoff))
    customers = _customers(past, as_time(cutoff), home_country, recent_days, LABEL_DAYS)
    return customers.select("customer_id", *FEATURE_COLUMNS)


def build_features(purchases, cancellations, cutoff, home_country=HOME_COUNTRY,
                   recent_days=RECENT_DAYS):
    return features_as_of(activity_of(purchases, cancellations), cutoff, home_country, recent_days)


def build_labels(purchases, customers, cutoff, label_days=LABEL_DAYS):
    """churned = 1 if the customer has no purchase in [cutoff, cutoff + label_days)."""
    cutoff = as_time(cutoff)
    date = F.col("invoice_date")
    buyers = (
        purchases.where((date >= cutoff) & (date < cutoff + days(label_days)))
        .select("customer_id").distinct()
        .withColumn("bought", F.lit(True))
    )
    return customers.select("customer_id").join(buyers, "customer_id", "left").select(
        "customer_id", flag(F.col("bought").isNull()).alias("churned"))


def eligible(features, max_recency_days=MAX_RECENCY_DAYS):
    return features.where(F.col("recency_days") <= max_recency_days)


def training_set(lines, cutoff, home_country=HOME_COUNTRY, recent_days=RECENT_DAYS,
                 label_days=LABEL_DAYS, max_recency_days=MAX_RECENCY_DAYS):
    """Features and label of the eligible customers, from one pass over an activity table."""
    cutoff = as_time(cutoff)
    needed = lines.where(F.col("invoice_date") < cutoff + days(label_days))
    customers = _customers(needed, cutoff, home_country, recent_days, label_days)
    return eligible(customers, max_recency_days)


def churn_rate(labelled):
    return labelled.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(F.col("churned").cast("double")).alias("churn_rate"),
    )
