"""All jobs in order, from CSV files to published tables."""
from pyspark.sql import functions as F

from cartwise.operators import modeling, reporting
from cartwise.plans import jobs
from cartwise.plans.registry import HOME, over_folder
from cartwise.schemas import COLUMN_NAMES


def test_from_files_to_dashboard_tables(spark, sf_dir, tmp_path):
    retail = over_folder(spark, sf_dir)
    names = {new: old for old, new in COLUMN_NAMES.items()}
    paths = []
    for i, part in enumerate(retail.parts):
        path = str(tmp_path / f"part{i}")
        text = part.withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))
        text.withColumnsRenamed(names).write.option("header", True).csv(path)
        paths.append(path)

    (loaded,) = jobs.load(spark, paths).collect()
    assert loaded["rows"] == retail.clean.count()
    assert spark.table("raw_transactions").count() == retail.raw.count()

    report = spark.table("load_report").first()
    assert report["rows_before"] - report["rows_removed"] == report["rows_after"] == retail.raw.count()
    assert report["rows_removed"] > 0

    summary = jobs.segment(spark, ks=(2, 3))
    assert summary.count() == 4
    assert [r["k"] for r in spark.table("segment_sweep").orderBy("k").collect()] == [2, 3]
    assert spark.table("customer_segments").count() == retail.clean.select("customer_id").distinct().count()

    model_path = str(tmp_path / "model")
    models = modeling.make_models(rounds=3)
    training = jobs.train(spark, model_path, home_country=HOME, models=models)
    assert training.best_name in models
    population = spark.table("training_population").first()
    assert population["customers"] > 0 and 0 < population["churn_rate"] < 1
    assert spark.table("model_metrics").count() == 12
    assert spark.table("training_runs").count() == 2
    assert spark.table("test_set").count() == training.test.count()

    local = jobs.explain_model(spark, model_path)
    assert local.count() == 9 and local.select("customer_id").distinct().count() == 1
    assert spark.table("feature_importance").columns == ["feature", "mean_abs_shap"]

    matrix = jobs.score(spark, model_path, home_country=HOME)
    scores = spark.table("customer_scores")
    high, medium, low = (matrix.agg(F.sum(c)).first()[0] for c in ("High", "Medium", "Low"))
    assert high + medium + low == scores.count() > 0
    kinds = dict(scores.dtypes)
    assert kinds["recency_days"] == "bigint" and kinds["is_uk"] == "int"
    assert reporting.risk_kpis(scores).first()["customers_scored"] == scores.count()
    assert reporting.model_kpis(spark.table("model_metrics")).first()["selected_test_roc_auc"] is not None
