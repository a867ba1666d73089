"""Split, train, cross-validate and select churn classifiers with Spark ML."""
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession, Window, functions as F

from ..schemas import FEATURE_COLUMNS, METRIC_LABELS
from ..sources.files import union_parts
from ..staging import checkpointed, run_together
from . import boosting, metrics
from .logistic import FrozenLogistic
from .ranking import shuffled_place

FOLDS = 5
MAX_CLASSES = 1000
#: Rows of the training data in one partition; a fit starts a task for each in every step.
ROWS_PER_PARTITION = 250_000
LOG_STATEMENT = "SELECT *, {} FROM __THIS__".format(
    ", ".join(f"log1p({name}) AS log_{name}" for name in FEATURE_COLUMNS))


def split_sizes(df, label="churned", test_share=0.2):
    """(label, test_size): ceil(test_share * n) rows in all, shared out in proportion.

    The training rows are given to the classes by largest remainder, in whole numbers;
    the test set is the rest. One row per class.
    """
    whole = Window.partitionBy()
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "total", F.sum("n").over(whole))
    train = (F.col("total") - F.ceil(F.col("total") * F.lit(test_share))).cast("decimal(19,0)")
    shared = classes.withColumn("train", train).withColumns({
        "floor": F.expr("cast(train * n DIV total AS bigint)"),
        "remainder": F.expr("train * n % total"),
    })
    extra = F.col("train").cast("long") - F.sum("floor").over(whole)
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("remainder"), label))
    return shared.select(
        label, (F.col("n") - F.col("floor") - F.when(place <= extra, 1).otherwise(0)).alias("test_size"))


def stratified_split(df, label="churned", test_share=0.2, seed=42, id_column="customer_id"):
    """(train, test) with the same share of every class in both, and exact sizes."""
    # One row per class; the limit turns a column that is no class label into an error.
    sizes = split_sizes(df, label, test_share)
    sizes = sizes.withColumn("test_size", F.when(
        F.count(F.lit(1)).over(Window.partitionBy()) <= MAX_CLASSES, F.col("test_size")
    ).otherwise(F.raise_error(F.lit(f"{label} has more than {MAX_CLASSES} values")).cast("long")))
    placed = shuffled_place(df, label, id_column, seed).join(F.broadcast(sizes), label)
    in_test = F.col("place") <= F.col("test_size")
    return (placed.where(~in_test).select(df.columns), placed.where(in_test).select(df.columns))


def with_folds(train, label="churned", folds=FOLDS, seed=42, id_column="customer_id"):
    """Add `fold`, with every class spread evenly over the folds."""
    placed = shuffled_place(train, label, id_column, f"fold-{seed}")
    return placed.select(*train.columns, (F.col("place") % folds).cast("int").alias("fold"))


def as_doubles(features):
    """Feature columns as doubles, other columns as they are."""
    return features.withColumns({c: F.col(c).cast("double") for c in FEATURE_COLUMNS})


def logistic_regression(rows, c=1.0, max_iter=1000):
    """Logistic regression on standardized log1p features with an L2 penalty of strength 1/c.

    `rows` is the size of the training data. Spark averages the loss, hence 1 / (c * rows);
    its scaler divides by the sample deviation, and (rows - 1) / rows on the penalty
    makes the model equal to one on population-scaled features.
    """
    return Pipeline(stages=[
        SQLTransformer(statement=LOG_STATEMENT),
        VectorAssembler(inputCols=[f"log_{name}" for name in FEATURE_COLUMNS], outputCol="logs"),
        StandardScaler(inputCol="logs", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol="churned", featuresCol="features", elasticNetParam=0.0,
                           regParam=(rows - 1) / (c * rows * rows), maxIter=max_iter,
                           standardization=False),
    ])


def boosted_trees(rounds=300, depth=3, step=0.05, row_share=0.8, column_share=0.8, seed=42,
                  checkpoint_interval=50):
    """First-order boosted trees as a pipeline; make_models takes those of boosting.py."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features"),
        GBTClassifier(labelCol="churned", featuresCol="features", maxIter=rounds, maxDepth=depth,
                      stepSize=step, subsamplingRate=row_share,
                      featureSubsetStrategy=str(column_share), seed=seed,
                      checkpointInterval=checkpoint_interval),
    ])


def estimated(estimator_for):
    """Way to fit a pipeline: the full fit, and one for each fold, all at the same time.

    estimator_for: function from the number of training rows to an unfitted estimator.
    """
    def fit(train, folds):
        rows = train.count()
        full, validated = run_together(train.sparkSession, lambda work: work(), [
            lambda: estimator_for(rows).fit(train), lambda: out_of_fold(estimator_for, train, folds)])
        return full, validated

    return fit


def boosted(settings=boosting.Settings()):
    """Way to fit boosted trees: one run grows the trees of all folds and of the full fit."""
    def fit(train, folds):
        models, blocks = boosting.fit(train, settings, fold_column="fold", folds=folds)
        return models[-1], boosting.out_of_fold(blocks, folds + 1)

    return fit


def make_models(rounds=300):
    """Name -> function of (training rows with their fold, folds) that gives the model fitted on all rows
    and every row's probability by the model that did not see its fold."""
    return {
        "logistic_regression": estimated(logistic_regression),
        "boosted_trees": boosted(boosting.Settings(rounds=rounds)),
    }


def _is_log_logistic(model):
    """Whether the model has the stages of logistic_regression()."""
    first, last = model.stages[0], model.stages[-1]
    return (isinstance(last, LogisticRegressionModel) and isinstance(first, SQLTransformer)
            and first.getStatement() == LOG_STATEMENT)


def with_probability(model, features):
    """Add churn_probability; the model's own columns are dropped.

    The log-scaled logistic model is evaluated as column expressions, without a call per row.
    """
    if isinstance(model, (FrozenLogistic, boosting.Trees)):
        return model.with_probability(features)
    if _is_log_logistic(model):
        return FrozenLogistic.from_fitted(model).with_probability(features)
    probability = vector_to_array("probability")[1].alias("churn_probability")
    return model.transform(features).select(*features.columns, probability)


def out_of_fold(estimator_for, folded, folds=FOLDS):
    """Probability of every training row from the model that was fitted without its fold."""
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    rows = sum(sizes.values())

    def predict_fold(fold):
        model = estimator_for(rows - sizes[fold]).fit(folded.where(F.col("fold") != fold))
        return with_probability(model, folded.where(F.col("fold") == fold))

    return union_parts(run_together(folded.sparkSession, predict_fold, sorted(sizes), folds))


class Training:
    """Fitted models, their metrics (one row per model) and the selected model."""

    def __init__(self, models, wide, test):
        self.models = models
        self.wide = checkpointed(wide)
        self.test = test
        self.best_name = metrics.best_model(self.wide).first()["model"]
        self.best = models[self.best_name]

    def metrics_table(self):
        return metrics.metrics_long(self.wide)

    def confusion_table(self):
        return metrics.confusion_matrix(with_probability(self.best, self.test))


def train_and_select(labelled, models=None, folds=FOLDS, seed=42):
    """Split, cross-validate on the training part, fit, test; the winner is chosen by CV."""
    models = models or make_models()
    spark = labelled.sparkSession
    data = checkpointed(as_doubles(labelled.select("customer_id", *FEATURE_COLUMNS, "churned")))
    train, test = stratified_split(data, seed=seed)
    train, test = checkpointed(with_folds(train, folds=folds, seed=seed)), checkpointed(test)
    rows = train.count()
    train, test = sized(train, rows).persist(), sized(test, rows)

    def named(scored, name):
        return scored.withColumn("model", F.lit(name))

    both = dict(zip(models, run_together(spark, lambda m: models[m](train, folds), models)))
    fitted = {name: model for name, (model, _) in both.items()}
    tested = union_parts([
        named(with_probability(model, test), name) for name, model in fitted.items()])
    validated = union_parts([
        named(scored.select("fold", "churned", "churn_probability"), name)
        for name, (_, scored) in both.items()])
    wide = metrics.compare_models(checkpointed(tested), checkpointed(validated), list(models))
    train.unpersist()
    return Training(fitted, wide, test)


def sized(df, rows):
    """As many partitions as the rows need: hundreds of steps each start a task per partition."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_PARTITION)))


def parameters(model):
    """Parameters of the last stage of a fitted model, as text."""
    if isinstance(model, boosting.Trees):
        return model.parameters()
    stage = model.stages[-1]
    return {p.name: str(v) for p, v in stage.extractParamMap().items()}


def training_runs(training):
    """One row per trained model: parameters and metrics, ready to be appended to a table."""
    spark = training.wide.sparkSession
    results = {row["model"]: {m: row[m] for m in METRIC_LABELS}
               for row in training.wide.collect()}
    rows = [(uuid.uuid4().hex, name, parameters(model), results[name])
            for name, model in training.models.items()]
    runs = spark.createDataFrame(
        rows, "run_id string, model string, params map<string,string>, metrics map<string,double>")
    return runs.select("run_id", F.current_timestamp().alias("recorded_at"),
                       "model", "params", "metrics")


def save_model(model, path):
    spark, trees = SparkSession.active(), isinstance(model, boosting.Trees)
    if trees:
        model.save(spark, f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    kind = spark.createDataFrame([("trees" if trees else "pipeline",)], "kind string")
    kind.write.mode("overwrite").parquet(f"{path}/kind")


def load_model(path):
    spark = SparkSession.active()
    if spark.read.parquet(f"{path}/kind").first()["kind"] == "trees":
        return boosting.Trees.load(spark, f"{path}/model")
    return PipelineModel.load(f"{path}/model")
