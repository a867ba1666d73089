"""Exact ranks and running totals without a window over the whole table.

An ordered window without a small partition key puts everything in one task. Here rows get
a bucket that grows with the order; totals per bucket give every bucket its starting
value, and the window only runs inside a bucket.
"""
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window, functions as F

HASH_BUCKET_DIGITS = 4  # 65 536 buckets
SCORE_BUCKETS = 1000


def running_totals(df, order, bucket, totals, group=()):
    """Add a running sum of every totals[name] column, in the order of `order`.

    `bucket` must not decrease along `order`. The starting values are one row per group
    and bucket, so their number is set by the bucketing and not by the data.
    """
    keys = [*group, bucket]
    per_bucket = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *keys, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_start") for n in totals])
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(starts, keys).select(
        *df.columns,
        *[(F.col(f"{n}_start") + F.sum(c).over(inside)).alias(n) for n, c in totals.items()])


def shuffled_place(df, group, id_column, seed):
    """1-based place of every row in a fixed random order of its group.

    The order is that of md5(seed:id), so it does not depend on partitioning and can be
    repeated by any engine.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))
    drawn = (
        df.withColumn("draw", draw)
        .withColumn("draw_bucket", F.substring("draw", 1, HASH_BUCKET_DIGITS))
    )
    placed = running_totals(drawn, "draw", "draw_bucket", {"place": F.lit(1)}, group=(group,))
    return placed.drop("draw", "draw_bucket")


def score_buckets(scores, column, buckets=SCORE_BUCKETS):
    """Add `bucket`, growing with the score, with about as many rows in each.

    The edges are a bounded array of quantiles; any edges give exact results, balanced
    ones only spread the work.
    """
    steps = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    edges = scores.selectExpr(f"percentile_approx({column}, array({steps}), {10 * buckets})").first()[0]
    splits = [float("-inf"), *sorted(set(edges or ())), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    return Bucketizer(splits=splits, inputCol=column, outputCol="bucket").transform(scores)
