"""RFM profile, scaling, clustering and named segments."""
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window, functions as F

from ..functions.columns import exact_sum, ratio, round_half_even, round_total_half_even, sum_of
from ..schemas import RFM_COLUMNS, SEGMENTS
from ..staging import checkpointed
from . import clustering

SCALED_COLUMNS = tuple(f"{c}_scaled" for c in RFM_COLUMNS)


def rfm(clean, last_day=None):
    """Calendar days since the last purchase, number of invoices and spend per customer.

    Lines are added up to orders first, so the heaviest customer is spread over the
    tasks and the count of distinct invoices becomes a plain count. Without a given last
    day, the latest date of the customers is used, a scalar subquery over the same exchange.
    """
    orders = clean.groupBy("customer_id", "invoice").agg(
        F.max("invoice_date").alias("last_line"), F.sum("line_total").alias("order_total"))
    customers = orders.groupBy("customer_id").agg(
        F.to_date(F.max("last_line")).alias("last_date"),
        F.count("invoice").alias("frequency"),
        F.sum("order_total").alias("monetary"),
    )
    if last_day is None:
        last_day = customers.agg(F.max("last_date")).scalar()
    else:
        last_day = F.lit(last_day).cast("date")
    return customers.select(
        "customer_id",
        (F.date_diff(last_day, "last_date") + 1).alias("recency_days"),
        "frequency",
        "monetary",
    )


def scaled(df, columns, mean, std):
    """log1p, then (x - mean) / std, with statistics given as numbers or columns.

    A constant column becomes 0.
    """
    def z(c):
        deviation = F.lit(std[c])
        return F.when(deviation > 0, (F.log1p(c) - F.lit(mean[c])) / deviation).otherwise(0.0)

    return df.withColumns({f"{c}_scaled": z(c) for c in columns})


def scale_features(df, columns=RFM_COLUMNS):
    """Zero mean and unit population variance of the log1p values, over all rows of df."""
    return scaled(df, columns, *scaler_parameters(df, columns))


def scaler_parameters(df, columns=RFM_COLUMNS):
    """Mean and population deviation of the log1p values: two dictionaries by column."""
    logs = df.select(*[F.log1p(c).alias(c) for c in columns])
    row = logs.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns],
                   *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]).first()
    return ({c: row[f"{c}_mean"] for c in columns}, {c: row[f"{c}_std"] for c in columns})


def nearest_centre(df, centres, columns=SCALED_COLUMNS):
    """Index of the closest centre (squared distance; the first of equals)."""
    def distance(centre):
        return sum_of([(F.col(c) - x) * (F.col(c) - x) for c, x in zip(columns, centre)])

    distances = F.array(*[distance(c) for c in centres])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return df.withColumn("cluster", nearest.cast("int"))


def _vectors(df, columns=SCALED_COLUMNS):
    return VectorAssembler(inputCols=list(columns), outputCol="vector").transform(df)


def fit_segments(scaled_rfm, k=4, n_init=10, seed=42, max_iter=300):
    """Best of n_init KMeans runs by total squared distance; all runs step together.

    A run stops once the centres move by less than 1e-4 in total squared distance.
    """
    models, blocks = clustering.fit(scaled_rfm, [k], SCALED_COLUMNS, n_init, seed, max_iter)
    blocks.unpersist()
    return models[k]


def choose_k(scaled_rfm, ks=range(2, 9), n_init=10, seed=42):
    """(k, inertia, silhouette, silhouette_error) for each k, from one set of steps for all of them.

    The silhouette is the plain Euclidean one; the mean over all pairs is within the error.
    """
    customers, ks = checkpointed(scaled_rfm), list(ks)
    models, blocks = clustering.fit(customers, ks, SCALED_COLUMNS, n_init, seed)
    found = clustering.silhouettes(customers, blocks, [models[k].centres for k in ks], SCALED_COLUMNS)
    blocks.unpersist()
    rows = [(k, float(models[k].cost), *map(float, s)) for k, s in zip(ks, found)]
    return scaled_rfm.sparkSession.createDataFrame(
        rows, "k int, inertia double, silhouette double, silhouette_error double")


def cluster_profile(clustered):
    return clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in RFM_COLUMNS])


def name_segments(profile):
    """Names of exactly four clusters: (cluster, segment).

    Two clusters count as active, those with the fewest days since the last purchase. Within
    the active and within the other two, the average spend decides which name comes first.
    The windows run over the four profile rows.
    """
    by_recency = Window.partitionBy().orderBy("recency_days", "cluster")
    by_spend = Window.partitionBy("active").orderBy(F.desc("monetary"), "cluster")
    ranked = (
        profile.withColumn("clusters", F.count(F.lit(1)).over(Window.partitionBy()))
        .withColumn("active", F.row_number().over(by_recency) <= 2)
        .withColumn("place", F.row_number().over(by_spend))
    )
    first, second, third, fourth = SEGMENTS
    name = (
        F.when(F.col("clusters") != 4, F.raise_error(F.lit("segment names need exactly 4 clusters")))
        .when(F.col("active"), F.when(F.col("place") == 1, first).otherwise(second))
        .otherwise(F.when(F.col("place") == 1, third).otherwise(fourth))
    )
    return ranked.select("cluster", name.alias("segment"))


def assign_segments(clustered):
    """Customers with their segment instead of the cluster number.

    The names are four rows (name_segments fails otherwise), a fixed size to broadcast.
    """
    names = name_segments(cluster_profile(clustered))
    return clustered.join(F.broadcast(names), "cluster", "left").select(
        "customer_id", *RFM_COLUMNS, "segment")


def segment_customers(clean, k=4, n_init=10, seed=42):
    """RFM, scaling, clustering and naming in one call."""
    return segment_rfm(rfm(clean), k, n_init, seed)


def segment_rfm(customers, k=4, n_init=10, seed=42):
    """Scaling, clustering and naming of a table of RFM values."""
    customers = checkpointed(scale_features(customers))
    model = fit_segments(customers, k, n_init, seed)
    return assign_segments(model.transform(customers))


def segment_summary(segments):
    """Size, averages and revenue per segment.

    The share divides totals that are already rounded to one digit, then rounds to three.
    """
    summary = segments.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        *[round_half_even(F.avg(c), 1).alias(f"avg_{c}") for c in RFM_COLUMNS],
        round_total_half_even(exact_sum("monetary"), 1).alias("total_revenue"),
    )
    total = F.sum("total_revenue").over(Window.partitionBy())
    return summary.withColumn(
        "revenue_share", round_half_even(ratio("total_revenue", total), 3)
    ).orderBy(F.desc("avg_monetary"))


def segment_shares(segments):
    """Share of customers and of revenue per segment, smallest revenue first."""
    everything = Window.partitionBy()
    return (
        segments.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue"))
        .withColumn("customer_share", ratio("customers", F.sum("customers").over(everything)))
        .withColumn("revenue_share", ratio("revenue", F.sum("revenue").over(everything)))
        .orderBy("revenue_share")
    )


def duplicated_customers(segments):
    """Customers with more than one row; must be empty before joining segments to scores."""
    return segments.groupBy("customer_id").count().where(F.col("count") > 1)
