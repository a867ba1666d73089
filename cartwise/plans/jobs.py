"""End-to-end jobs: each reads published tables and publishes new ones."""
from ..operators import cleaning, explain, features, modeling, scoring, segments
from ..operators.logistic import FrozenLogistic
from ..schemas import HOME_COUNTRY
from ..sources import files


def load(spark, csv_paths, table="raw_transactions"):
    """Merge and dedupe source files into the base table and create the cleaned views.

    Lines that do not fit the source schema, or whose customer id has a fraction, are
    published as rejected_lines, the numbers of rows before and after merging as load_report.
    """
    parts, rejected = files.read_parts(spark, csv_paths, whole_columns=files.ID_COLUMNS, parse_once=True)
    files.publish(rejected, "rejected_lines")
    merged, report = files.merge_parts_counted(parts)
    files.create_base_table(files.to_raw_transactions(merged), table)
    files.publish(report, "load_report")
    cleaning.create_views(spark.table(table))
    return files.row_count(spark.table("clean_transactions"))


def segment(spark, table="raw_transactions", ks=range(2, 9)):
    """Publish the customers with their segments, and the sweep over numbers of segments."""
    customers = segments.rfm(cleaning.clean_transactions(spark.table(table)))
    files.publish(segments.segment_rfm(customers), "customer_segments")
    published = spark.table("customer_segments").drop("segment")
    files.publish(segments.choose_k(segments.scale_features(published), ks), "segment_sweep")
    return segments.segment_summary(spark.table("customer_segments"))


def train(spark, model_path, table="raw_transactions", home_country=HOME_COUNTRY, models=None):
    """Train, select and save; publish metrics, confusion matrix, test set and run records."""
    raw = spark.table(table)
    cutoff = features.training_cutoff(cleaning.clean_transactions(raw), raw=raw)
    labelled = features.training_set(features.activity(raw), cutoff, home_country)
    files.publish(labelled, "training_set")
    labelled = spark.table("training_set")
    files.publish(features.churn_rate(labelled), "training_population")
    training = modeling.train_and_select(labelled, models)
    modeling.save_model(training.best, model_path)
    files.publish(training.test, "test_set")
    files.publish(training.metrics_table(), "model_metrics")
    files.publish(training.confusion_table(), "confusion_matrix")
    files.append_rows(modeling.training_runs(training), "training_runs")
    return training


def attribution(model, rows):
    """Attribution by the kind of the fitted model."""
    if hasattr(model, "leaves") or hasattr(model.stages[-1], "trees"):
        return explain.tree_attribution(rows, explain.tree_leaves(model))
    return explain.linear_attribution(rows, FrozenLogistic.from_fitted(model))


def explain_model(spark, model_path):
    model = modeling.load_model(model_path)
    test = spark.table("test_set")
    files.publish(attribution(model, test), "feature_attribution")
    phi = spark.table("feature_attribution")
    files.publish(explain.mean_absolute(phi), "feature_importance")
    return explain.explain_riskiest(modeling.with_probability(model, test), phi)


def score(spark, model_path, table="raw_transactions", home_country=HOME_COUNTRY):
    segmented = spark.table("customer_segments")
    repeated = segments.duplicated_customers(segmented).limit(5).collect()
    if repeated:
        raise ValueError(f"customer_segments has several rows for {[r.customer_id for r in repeated]}")
    raw = spark.table(table)
    today = features.data_end(cleaning.clean_transactions(raw), raw)
    scores = scoring.score_customers(
        features.activity(raw), today, modeling.load_model(model_path),
        segmented, home_country)
    files.publish(scores, "customer_scores")
    return scoring.segment_risk_matrix(spark.table("customer_scores"))
