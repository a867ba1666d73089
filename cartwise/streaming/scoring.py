"""Scoring of feature rows as they arrive. Every row stands alone: no state, no watermark."""
from ..operators.scoring import predict, validate_features
from ..schemas import FEATURES


def read_feature_stream(spark, path, schema=FEATURES, files_per_trigger=1000):
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def start_predictions(stream, model, output, checkpoint, trigger=None):
    """Write predictions of valid rows to a parquet folder, exactly once per row."""
    return _start(predict(stream, model), output, checkpoint, trigger)


def start_rejects(stream, output, checkpoint, trigger=None):
    """Write rows that break a rule, with the names of the fields at fault."""
    _, rejected = validate_features(stream)
    return _start(rejected, output, checkpoint, trigger)


def start_both(stream, model, predictions, rejects, checkpoint, trigger=None):
    """Write predictions and rejected rows of one stream, which is read once.

    Every batch has a folder of its own in both places, named by its number. A batch that is repeated after
    a failure replaces its folders, so each row is there once. Read them with read_batches.
    """
    def write(batch, number):
        batch.persist()
        _, bad = validate_features(batch)
        predict(batch, model).write.mode("overwrite").parquet(f"{predictions}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        batch.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_batches(spark, folder):
    return spark.read.parquet(folder).drop("batch")


def _start(df, output, checkpoint, trigger):
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
