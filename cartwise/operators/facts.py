"""Customer facts kept as a table that batches of new lines are added to.

A batch of lines becomes a few facts per customer: orders (spend and lines at a date), products and cancelled
orders (date of the first line), countries (lines at a date). Facts are added up or the earliest is
taken, so those of a batch are appended as they are and no old line is read again; reading the table adds
them up, and compacting it makes one row of many. Dates stay in the facts, hence features as of any date, and
the label, follow from them as from the lines.

Lines must not come twice: sources/incremental.py finds those that are in the table already.
"""
from pyspark.sql import functions as F

from ..functions.columns import as_time, days
from ..schemas import FEATURE_COLUMNS, HOME_COUNTRY, LABEL_DAYS, MAX_RECENCY_DAYS, RECENT_DAYS
from ..sources.files import publish
from .features import CANCELLED, COUNTRY, LATER, ORDER, PRODUCT, customers_of, eligible

KEYS = ("customer_id", "kind", "key", "at")


def facts_of(lines):
    """(customer_id, kind, key, at, first, total, lines) of an activity table."""
    bought, date = F.col("is_purchase"), F.col("invoice_date")
    facts = lines.where(F.col("customer_id").isNotNull() & date.isNotNull()).select(
        "customer_id", "invoice_date", "line_total", F.stack(
            F.lit(3),
            F.when(bought, ORDER).otherwise(CANCELLED), F.col("invoice"), F.when(bought, date),
            F.lit(PRODUCT), F.when(bought, F.col("stock_code")), F.lit(None).cast("timestamp_ntz"),
            F.lit(COUNTRY), F.when(bought, F.col("country")), F.when(bought, date),
        ).alias("kind", "key", "at"))
    return facts.where(F.col("key").isNotNull()).groupBy(*KEYS).agg(
        F.min("invoice_date").alias("first"),
        F.sum(F.when(F.col("kind") == ORDER, F.col("line_total"))).alias("total"),
        F.count(F.lit(1)).alias("lines"))


def added_up(facts):
    """One row per key of facts from several batches."""
    return facts.groupBy(*KEYS).agg(
        F.min("first").alias("first"), F.sum("total").alias("total"), F.sum("lines").alias("lines"))


def add_batch(lines, name):
    """Append the facts of new lines to the table."""
    facts_of(lines).write.mode("append").saveAsTable(name)


def compact(spark, name):
    """Replace the table by one with a single row per key."""
    publish(added_up(spark.table(name)), name)


def _as_of(facts, cutoff, label_days):
    """Facts by (customer, kind, key) as the features need them: the past, and whether there is more later."""
    kind, first = F.col("kind"), F.col("first")
    later = (kind == ORDER) & (first >= cutoff) & (first < cutoff + days(label_days))
    known = facts.select(
        "customer_id", F.when(later, LATER).when(first < cutoff, kind).alias("kind"),
        F.when(later, "").otherwise(F.col("key")).alias("key"), "first", "total", "lines")
    is_order = kind == ORDER
    return known.where(kind.isNotNull()).groupBy("customer_id", "kind", "key").agg(
        F.min(F.when(is_order, first)).alias("order_date"),
        F.sum(F.when(is_order, F.col("total"))).alias("order_total"),
        F.sum("lines").alias("lines"))


def features_from(facts, cutoff, home_country=HOME_COUNTRY, recent_days=RECENT_DAYS):
    """The nine features as of the cutoff, as features_as_of has them from the lines."""
    cutoff = as_time(cutoff)
    past = _as_of(facts.where(F.col("first") < cutoff), cutoff, LABEL_DAYS)
    return customers_of(past, cutoff, home_country, recent_days).select("customer_id", *FEATURE_COLUMNS)


def training_set_from(facts, cutoff, home_country=HOME_COUNTRY, recent_days=RECENT_DAYS, label_days=LABEL_DAYS,
                      max_recency_days=MAX_RECENCY_DAYS):
    """Features and label of the eligible customers."""
    cutoff = as_time(cutoff)
    return eligible(customers_of(_as_of(facts, cutoff, label_days), cutoff, home_country, recent_days),
                    max_recency_days)
