"""Session settings the operators are written for."""
from pyspark.sql import SparkSession


def builder(app="cartwise"):
    """Adaptive plans with skew handling, and times without a zone shift.

    Set spark.checkpoint.dir to a folder all executors share.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
