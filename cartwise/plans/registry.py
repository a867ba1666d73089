"""Every registered query: name -> function of (spark, folder with the test tables).

Each one starts from the whole tables. Sums of doubles are rounded here, and only here,
because their last digits depend on the order of summation.
"""
import uuid
from functools import cached_property

import numpy as np
from pyspark.sql import functions as F

from ..functions.columns import as_time
from ..operators import (boosting, cleaning, clustering, explain, exploration, facts, features, metrics,
                         modeling, reporting, scoring, segments)
from ..schemas import COLUMN_NAMES, FEATURE_COLUMNS, RFM_COLUMNS, SPANISH
from ..sources import files, incremental, retail_view
from ..staging import checkpointed, new_folder
from ..streaming import scoring as streaming
from . import frozen

HOME = retail_view.HOME_COUNTRY
OVERLAP_START, OVERLAP_END = "1998-01-01", "1998-01-10"


class Retail:
    """The tables a query may need, over one table of raw invoice lines.

    All of them are lazy except the two dates, which are read once when first used.
    """

    def __init__(self, raw):
        self.spark = raw.sparkSession
        self.raw = raw

    @cached_property
    def clean(self):
        return cleaning.clean_transactions(self.raw)

    @cached_property
    def cancelled(self):
        return cleaning.cancellations(self.raw)

    @cached_property
    def activity(self):
        return features.activity(self.raw)

    @cached_property
    def cutoff(self):
        return features.training_cutoff(self.clean)

    @cached_property
    def today(self):
        return features.data_end(self.clean)

    @cached_property
    def parts(self):
        """Two slices of the lines that overlap by some days."""
        date = F.col("invoice_date")
        return [self.raw.where(date < as_time(OVERLAP_END)),
                self.raw.where(date >= as_time(OVERLAP_START))]

    @cached_property
    def past(self):
        return self.clean.where(F.col("invoice_date") < as_time(self.cutoff))

    @cached_property
    def training(self):
        return features.training_set(self.activity, self.cutoff, HOME)

    @cached_property
    def current(self):
        return features.features_as_of(self.activity, self.today, HOME)

    @cached_property
    def rfm(self):
        return segments.rfm(self.clean)

    @cached_property
    def clustered(self):
        """RFM with the nearest frozen centre. Naming reads it twice, over the same exchange."""
        scaled = segments.scaled(self.rfm, RFM_COLUMNS, frozen.RFM_MEANS, frozen.RFM_STDS)
        return segments.nearest_centre(scaled, frozen.CENTRES)

    @cached_property
    def segments(self):
        return segments.assign_segments(self.clustered)

    @cached_property
    def scored(self):
        """Labelled training customers with the probability of the frozen model."""
        return frozen.model().with_probability(self.training)

    @cached_property
    def scores(self):
        """Current customers as published for the dashboard."""
        return scoring.score_customers(
            self.activity, self.today, frozen.model(), self.segments, HOME)

    @cached_property
    def risks(self):
        """Current customers scored, for measures that show no segment."""
        return scoring.score_customers(self.activity, self.today, frozen.model(), None, HOME)

    @cached_property
    def folded(self):
        return modeling.with_folds(checkpointed(self.training))

    @cached_property
    def comparison(self):
        """Both frozen models on all labelled customers, and per fold."""
        models = {"logistic_regression": frozen.model(), "boosted_trees": frozen.second_model()}
        scored = checkpointed(files.union_parts([
            m.with_probability(self.folded).select("fold", "churned", "churn_probability")
            .withColumn("model", F.lit(name)) for name, m in models.items()]))
        return checkpointed(metrics.compare_models(scored, scored, list(models)))

    @cached_property
    def attribution(self):
        return explain.linear_attribution(features.eligible(self.current), frozen.model())

    @cached_property
    def requests(self):
        """Feature rows in which every 7th customer breaks one rule and every 11th another."""
        rows = self.current.select(
            "customer_id", *[F.col(c).cast("double") for c in FEATURE_COLUMNS])
        customer, recency, frequency = (
            F.col(c) for c in ("customer_id", "recency_days", "frequency"))
        return rows.withColumns({
            "recency_days": F.when(customer % 7 == 0, -1.0).otherwise(recency),
            "frequency": F.when(customer % 11 == 0, F.lit(None)).otherwise(frequency),
        })

    @cached_property
    def trained(self):
        return modeling.train_and_select(self.training)


def rounded(df, digits=2, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _features_rounded(df):
    return rounded(rounded(df, 2, "monetary"), 6, "avg_order_value", "cancel_rate")


def _scores_rounded(df):
    return rounded(_features_rounded(df), 6, "churn_probability")


def _action_rounded(df):
    return rounded(rounded(df, 2, "monetary"), 6, "churn_probability", "avg_order_value")


def _predictions(df):
    return df.select("customer_id", "churn_probability", "will_churn")


def predict_stream(r):
    """The requests of predict_batch through a file stream."""
    inbox, output, state = (new_folder(r.spark, n) for n in ("requests", "predictions", "state"))
    files.write_files(r.requests, inbox)
    stream = streaming.read_feature_stream(r.spark, inbox)
    streaming.start_predictions(stream, frozen.model(), output, state).awaitTermination()
    return _predictions(r.spark.read.parquet(output))


def stream_both(r):
    """Predictions and rejected requests of one stream that comes in two halves."""
    inbox, good, bad, state = (new_folder(r.spark, n) for n in ("requests", "predictions", "rejects", "state"))
    for half in (0, 1):
        r.requests.where(F.col("customer_id") % 2 == half).write.mode("append").parquet(inbox)
        stream = streaming.read_feature_stream(r.spark, inbox)
        streaming.start_both(stream, frozen.model(), good, bad, state).awaitTermination()
    rejected = streaming.read_batches(r.spark, bad)
    return _predictions(streaming.read_batches(r.spark, good)).unionByName(rejected.select(
        "customer_id", F.array_join("violations", ",").alias("violations")), allowMissingColumns=True)


def read_transactions_csv(r):
    """The raw lines written as source files and read back with declared types."""
    folder = new_folder(r.spark, "source")
    source = r.raw.withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))
    names = {new: old for old, new in COLUMN_NAMES.items()}
    files.write_files(source.withColumnsRenamed(names), folder, "csv")
    return files.read_transactions_csv(r.spark, folder)[0]


def read_quoted_breaks(r):
    """The raw lines as source files with line breaks and quotes in the descriptions, read by parts of files."""
    folder = new_folder(r.spark, "source")
    source = r.raw.withColumns({
        "invoice_date": F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"),
        "description": F.concat(F.lit('a "b",\n'), "description", F.lit('\n\n,"'))})
    names = {new: old for old, new in COLUMN_NAMES.items()}
    # The source format doubles the quotes within a cell.
    source.withColumnsRenamed(names).write.option("header", True).option("escape", '"').csv(folder)
    return files.read_transactions_csv(r.spark, folder, multi_line="parallel")[0]


def read_parts(r):
    """Both slices as source files whose columns come in different orders, read and merged."""
    folders = []
    for part in r.parts:
        folder = new_folder(r.spark, "part")
        source = part.withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))
        names = {new: old for old, new in COLUMN_NAMES.items()}
        columns = source.columns if not folders else source.columns[::-1]
        files.write_files(source.select(columns).withColumnsRenamed(names), folder, "csv")
        folders.append(folder)
    parts, _ = files.read_parts(r.spark, folders, whole_columns=files.ID_COLUMNS)
    return files.to_raw_transactions(files.merge_parts(parts))


def _table_name(kind):
    return f"{kind}_{uuid.uuid4().hex}"


def base_table(r):
    name = _table_name("base")
    files.create_base_table(r.raw, name)
    return files.taken(name, r.spark)


def two_way_table(r):
    name = _table_name("base")
    files.create_two_way_table(r.raw, name)
    return files.taken(name, r.spark)


def append_base_table(r):
    name, (first, second) = _table_name("base"), r.parts
    files.create_base_table(first, name)
    files.append_to_base_table(second, name)
    return files.taken(name, r.spark)


def append_overlapping(r):
    """A second period that overlaps the loaded one: only lines that are not there are added."""
    name, (first, second) = _table_name("base"), r.parts
    incremental.create_filtered_table(first.dropDuplicates(), name)
    incremental.append_new_lines(second, name)
    r.spark.sql(f"DROP TABLE {incremental.filter_name(name)}")
    return files.taken(name, r.spark)


def features_by_batch(r):
    """Features as of the cutoff from facts that three batches of lines were added to."""
    name, date = _table_name("facts"), F.col("invoice_date")
    edges = [None, "1994-01-01", "1997-01-01", None]
    for low, high in zip(edges, edges[1:]):
        batch = r.activity
        batch = batch if low is None else batch.where(date >= as_time(low))
        batch = batch if high is None else batch.where(date < as_time(high))
        facts.add_batch(batch, name)
    facts.compact(r.spark, name)
    return _features_rounded(facts.features_from(files.taken(name, r.spark), r.cutoff, HOME))


def published_table(r):
    name = _table_name("published")
    files.publish(r.rfm, name)
    files.publish(_features_rounded(r.training), name)
    files.publish(r.spark.table(name).where("customer_id IS NOT NULL"), name)  # from the table itself
    return files.taken(name, r.spark)


def sql_views(r):
    """A question in SQL over both views."""
    cleaning.create_views(r.raw)
    return r.spark.sql("""SELECT country, count(*) AS lines, count(DISTINCT customer_id) AS customers
        FROM clean_transactions WHERE customer_id IN (SELECT customer_id FROM cancellations)
        GROUP BY country""")


def read_features(r):
    """Feature rows written as a file and read back with the declared schema."""
    folder = new_folder(r.spark, "features")
    files.write_files(_features_rounded(r.current).select(
        "customer_id", *[F.col(c).cast("double") for c in FEATURE_COLUMNS]), folder)
    return files.read_features(r.spark, folder)


def stratified_split(r):
    _, test = modeling.stratified_split(checkpointed(r.training))
    return test.select("customer_id", "churned")


def split_sizes(r):
    train, test = modeling.stratified_split(checkpointed(r.training))
    both = train.select("churned", F.lit("train").alias("part")).unionByName(
        test.select("churned", F.lit("test").alias("part")))
    return both.groupBy("part", "churned").agg(F.count(F.lit(1)).alias("customers"))


def trained_tree_attribution(r):
    """Trees fitted on the training part, explained on the test part."""
    train, test = modeling.stratified_split(checkpointed(modeling.as_doubles(r.training)))
    (fitted,), _ = boosting.fit(checkpointed(train))
    return explain.tree_attribution(test, fitted.leaves())


def boosting_round(r):
    """The first tree on all labelled customers, node by node."""
    settings = boosting.Settings(rounds=1)
    (fitted,), _ = boosting.fit(checkpointed(modeling.as_doubles(r.training)), settings)
    nodes = rounded(fitted.table(r.spark).drop("tree"), 4, "threshold", "gain", "cover")
    return rounded(nodes, 7, "value")


def scaled_by_frozen(r):
    return checkpointed(segments.scaled(r.rfm, RFM_COLUMNS, frozen.RFM_MEANS, frozen.RFM_STDS))


def kmeans_step(r):
    """One step of several KMeans runs from fixed centres: cluster sizes, new centres and the cost before."""
    blocks, _ = clustering.blocks_of(scaled_by_frozen(r), segments.SCALED_COLUMNS)
    runs = [np.array(frozen.CENTRES[:k]) for k in (2, 3, 4)]
    rows = [(len(n), i, int(n[i]), *map(float, moved[i]), float(cost))
            for n, moved, cost in clustering.step(blocks, runs) for i in range(len(n))]
    blocks.unpersist()
    names = ", ".join(f"{c} double" for c in RFM_COLUMNS)
    found = r.spark.createDataFrame(rows, f"k int, cluster int, customers long, {names}, cost double")
    return rounded(rounded(found, 5, *RFM_COLUMNS), 3, "cost")


def silhouette(r):
    """Plain Euclidean silhouette of the customers under fixed centres."""
    customers = scaled_by_frozen(r)
    blocks, _ = clustering.blocks_of(customers, segments.SCALED_COLUMNS)
    runs = [np.array(frozen.CENTRES[:k]) for k in (2, 3, 4)]
    found = clustering.silhouettes(customers, blocks, runs, segments.SCALED_COLUMNS)
    blocks.unpersist()
    rows = [(len(c), float(s), error < 0.005) for c, (s, error) in zip(runs, found)]
    return rounded(r.spark.createDataFrame(rows, "k int, silhouette double, close boolean"), 2, "silhouette")


def no_leakage(r):
    """Features that differ when lines at or after the cutoff are there: must be empty."""
    past = r.activity.where(F.col("invoice_date") < as_time(r.cutoff))
    with_future, without = (_features_rounded(features.features_as_of(lines, r.cutoff, HOME))
                            for lines in (r.activity, past))
    both = with_future.withColumn("side", F.lit(1)).unionByName(without.withColumn("side", F.lit(-1)))
    return both.groupBy(*with_future.columns).agg(F.sum("side").alias("side")).where("side <> 0").drop("side")


def riskiest_explained(r):
    current = checkpointed(features.eligible(r.current))
    scores = frozen.model().with_probability(current)
    return explain.explain_riskiest(scores, explain.linear_attribution(current, frozen.model()))


TABLE_QUERIES = {
    # Cleaning and loading
    "raw_transactions": lambda r: r.raw,
    "clean_transactions": lambda r: r.clean,
    "cancellations": lambda r: r.cancelled,
    "read_transactions_csv": read_transactions_csv,
    "read_quoted_breaks": read_quoted_breaks,
    "read_parts": read_parts,
    "base_table": base_table,
    "two_way_table": two_way_table,
    "append_base_table": append_base_table,
    "append_overlapping": append_overlapping,
    "published_table": published_table,
    "sql_views": sql_views,
    "read_features": read_features,
    "merge_parts": lambda r: files.merge_parts(r.parts),
    "duplicates_removed": lambda r: files.duplicates_removed(r.parts),
    "fractional_ids": lambda r: files.fractional_ids(
        r.raw.select("invoice", (F.col("customer_id") / 2).alias("customer_id"))),
    "clean_row_count": lambda r: files.row_count(r.clean),
    "cleaning_summary": lambda r: cleaning.cleaning_summary(r.raw),
    "cancelled_invoice_share": lambda r: cleaning.cancelled_invoice_share(r.raw),
    # Exploration
    "monthly_revenue": lambda r: exploration.monthly_revenue(r.clean),
    "monthly_revenue_exact": lambda r: exploration.monthly_revenue(r.clean, digits=None).withColumn(
        "revenue", F.col("revenue").cast("double")),
    "sales_rollup": lambda r: rounded(exploration.distinct_sales(
        exploration.sales_rollup(r.clean), ("month", "country")).withColumn("revenue", F.col("revenue").cast("double")),
        2, "revenue"),
    "rolling_sales": lambda r: rounded(exploration.rolling_sales(
        exploration.sales_rollup(r.clean)).withColumn("revenue", F.col("revenue").cast("double")), 2, "revenue"),
    "top_countries": lambda r: exploration.top_countries(r.clean),
    "country_revenue_share": lambda r: rounded(rounded(
        exploration.country_revenue_share(r.clean), 2, "revenue"), 6, "revenue_share"),
    "top_products": lambda r: exploration.top_products(r.clean),
    "order_count_distribution": lambda r: exploration.order_count_distribution(r.clean),
    "order_count_clipped": lambda r: exploration.order_count_clipped(r.clean),
    "single_order_share": lambda r: rounded(
        exploration.single_order_share(r.clean), 6, "single_order_share"),
    # Features and labels
    "reference_dates": lambda r: features.reference_dates(r.clean),
    "order_rollup": lambda r: rounded(features.order_rollup(r.past), 2, "order_total"),
    "main_country": lambda r: features.main_country(r.past),
    "distinct_products": lambda r: features.distinct_per_customer(
        r.past, "stock_code", "distinct_products"),
    "cancelled_orders": lambda r: features.distinct_per_customer(
        r.cancelled.where(F.col("invoice_date") < as_time(r.cutoff)),
        "invoice", "cancelled_orders"),
    "customer_features": lambda r: _features_rounded(
        features.features_as_of(r.activity, r.cutoff, HOME)),
    "features_by_batch": features_by_batch,
    "no_leakage": no_leakage,
    "churn_labels": lambda r: features.build_labels(
        r.clean, r.past.select("customer_id").distinct(), r.cutoff),
    "training_set": lambda r: _features_rounded(r.training),
    "churn_rate": lambda r: rounded(features.churn_rate(r.training), 6, "churn_rate"),
    # Segments
    "rfm": lambda r: rounded(r.rfm, 2, "monetary"),
    "scaled_rfm": lambda r: rounded(
        segments.scale_features(r.rfm), 6, *segments.SCALED_COLUMNS
    ).select("customer_id", *segments.SCALED_COLUMNS),
    "segment_assignment_frozen": lambda r: rounded(r.segments, 2, "monetary"),
    "name_segments": lambda r: segments.name_segments(segments.cluster_profile(r.clustered)),
    "segment_summary": lambda r: segments.segment_summary(r.segments),
    "segment_shares": lambda r: rounded(rounded(
        segments.segment_shares(r.segments), 2, "revenue"),
        6, "customer_share", "revenue_share"),
    "duplicated_customers": lambda r: segments.duplicated_customers(r.segments),
    "repeated_customers": lambda r: segments.duplicated_customers(
        r.segments.unionByName(r.segments.where("segment = 'Champions'"))),
    "kmeans_segments": lambda r: rounded(segments.segment_customers(r.clean), 2, "monetary"),
    "kmeans_step": kmeans_step,
    "silhouette": silhouette,
    "choose_k": lambda r: segments.choose_k(segments.scale_features(checkpointed(r.rfm))),
    # Models
    "stratified_split": stratified_split,
    "split_sizes": split_sizes,
    "stratified_folds": lambda r: r.folded.select("customer_id", "churned", "fold"),
    "frozen_scores": lambda r: rounded(r.scored, 6, "churn_probability").select(
        "customer_id", "churned", "churn_probability"),
    "boosting_round": boosting_round,
    "train_and_select": lambda r: r.trained.metrics_table(),
    "training_runs": lambda r: modeling.training_runs(r.trained).drop("recorded_at"),
    "roc_auc": lambda r: rounded(metrics.roc_auc(r.scored), 6, "roc_auc"),
    "average_precision": lambda r: rounded(
        metrics.average_precision(r.scored), 6, "average_precision"),
    "threshold_metrics": lambda r: rounded(
        metrics.threshold_metrics(r.scored), 6, "precision", "recall", "f1"),
    "confusion_matrix": lambda r: metrics.confusion_matrix(r.scored),
    "metrics_long": lambda r: rounded(
        metrics.metrics_long(r.comparison), 6, "value"),
    "best_model": lambda r: metrics.best_model(r.comparison).select("model"),
    # Explanation
    "linear_attribution": lambda r: rounded(
        r.attribution, 6, "phi", "value"),
    "feature_importance": lambda r: rounded(
        explain.feature_importance(r.attribution), 6, "mean_abs_shap"),
    "riskiest_customer": lambda r: scoring.riskiest_customers(
        r.scores).select("customer_id", F.round("churn_probability", 6).alias("churn_probability"),
                         "risk_level", "segment"),
    "riskiest_explained": lambda r: rounded(
        riskiest_explained(r), 6, "churn_probability", "value", "phi"),
    "frozen_tree_attribution": lambda r: rounded(
        explain.tree_attribution(
            features.eligible(r.current), frozen.leaves()), 6, "phi", "value"),
    "tree_attribution": trained_tree_attribution,
    # Scoring
    "score_customers": lambda r: _scores_rounded(r.scores),
    "segment_risk_matrix": lambda r: scoring.segment_risk_matrix(r.scores),
    "validated_features": lambda r: _features_rounded(scoring.validate_features(r.requests)[0]),
    "rejected_features": lambda r: scoring.validate_features(
        r.requests)[1].select(
            "customer_id", F.array_join("violations", ",").alias("violations")),
    "predict_batch": lambda r: _predictions(scoring.predict(
        r.requests, frozen.model())),
    "predict_stream": predict_stream,
    "stream_both": stream_both,
    # Dashboard
    "segment_kpis": lambda r: rounded(rounded(
        reporting.segment_kpis(r.segments), 2, "revenue"), 4, "avg_spend", "avg_orders"),
    "shares_by_segment": lambda r: rounded(
        reporting.shares_by_segment(r.segments), 6, "customer_share", "revenue_share"),
    "segment_profile": lambda r: rounded(
        reporting.segment_profile(r.segments), 4,
        "avg_days_since_last_order", "avg_orders", "avg_spend", "revenue_share"),
    "sliced_segment_measures": lambda r: rounded(reporting.segment_measures(
        r.segments, ("customers", "customer_share", "revenue_share"),
        segment_slicer=["Champions", "Lost"]), 6, "customer_share", "revenue_share"),
    "spend_scatter": lambda r: rounded(rounded(
        reporting.spend_scatter(r.segments), 2, "monetary"), 6, "log_monetary"),
    "risk_kpis": lambda r: rounded(rounded(
        reporting.risk_kpis(r.risks), 2, "revenue_at_risk"), 6, "high_risk_share"),
    "sliced_risk_kpis": lambda r: rounded(rounded(reporting.risk_measures(
        r.scores, segment_slicer=["Champions", "Promising"], risk_slicer=["Low", "Medium"]),
        2, "revenue_at_risk"), 6, "high_risk_share", "avg_churn_probability"),
    "risk_cube": lambda r: rounded(rounded(
        reporting.cube_totals(reporting.risk_cube(r.scores)), 2, "revenue"), 6, "avg_churn_probability"),
    "cube_slices": lambda r: rounded(rounded(reporting.cube_measures(
        reporting.risk_cube(r.scores), ("segment",), ["Champions", "Promising", "Lost"], ["Low", "High"]),
        2, "revenue_at_risk"), 6, "high_risk_share", "avg_churn_probability"),
    "customers_by_segment_and_risk": lambda r: reporting.customers_by_segment_and_risk(
        r.scores),
    "avg_probability_by_segment": lambda r: rounded(
        reporting.avg_probability_by_segment(r.scores), 6, "avg_churn_probability"),
    "probability_bands": lambda r: reporting.probability_bands(r.scores),
    "action_list": lambda r: _action_rounded(reporting.action_list(r.scores)),
    "action_kpis": lambda r: rounded(
        reporting.action_kpis(r.risks), 2, "revenue_at_risk"),
    "model_kpis": lambda r: rounded(
        reporting.model_kpis(metrics.metrics_long(r.comparison)), 6,
        "selected_test_roc_auc", "selected_recall", "selected_precision", "cv_roc_auc_gain"),
    "metrics_by_model": lambda r: rounded(reporting.metrics_by_model(
        metrics.metrics_long(r.comparison), ("metric_es", "model_es")), 6, "value"),
    "confusion_pivot": lambda r: reporting.confusion_pivot(
        metrics.confusion_matrix(r.scored)),
    "confusion_total": lambda r: reporting.confusion_total(
        metrics.confusion_matrix(r.scored)),
    "importance_chart": lambda r: rounded(reporting.importance_chart(
        explain.mean_absolute(r.attribution), "feature_label_es"), 6, "mean_abs_shap"),
    "localized_segments": lambda r: reporting.report_scores(r.scores).select(
        "customer_id", "segment_es", "segment_order", "risk_level_es", "risk_order",
        "probability_band"),
    "localized_profile": lambda r: reporting.customers_by_segment_and_risk(
        r.scores, labels=("segment_es", "risk_level_es")),
    "untranslated_labels": lambda r: reporting.untranslated_labels(
        r.segments.join(r.raw.select("customer_id", "country").distinct(), "customer_id"),
        ["segment", "country"], {"segment": SPANISH["segment"], "country": {HOME: "Casa"}}),
    "slicer_values": lambda r: reporting.slicer_values(r.scores, "segment"),
}


def over_folder(spark, sf_dir):
    return Retail(retail_view.raw_transactions(spark, sf_dir))


def _over_folder(query):
    return lambda spark, sf_dir: query(over_folder(spark, sf_dir))


QUERIES = {name: _over_folder(query) for name, query in TABLE_QUERIES.items()}
