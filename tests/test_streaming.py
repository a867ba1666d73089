from cartwise.operators import scoring
from cartwise.plans import frozen
from cartwise.sources import files
from cartwise.streaming import scoring as streaming

from test_scoring import LOYAL, ONE_TIME, changed, rows


def test_stream_gives_the_batch_answer_and_continues(spark, tmp_path):
    inbox, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    broken = changed(LOYAL, customer_id=3, recency_days=-1.0)
    batch = rows(spark, LOYAL, broken)
    batch.write.parquet(inbox)

    def run():
        stream = streaming.read_feature_stream(spark, inbox)
        streaming.start_predictions(stream, frozen.model(), out, str(tmp_path / "c1")).awaitTermination()
        streaming.start_rejects(stream, bad, str(tmp_path / "c2")).awaitTermination()

    run()
    batch.unionByName(rows(spark, ONE_TIME)).where("customer_id = 2").write.mode("append").parquet(inbox)
    run()
    expected = scoring.predict(rows(spark, LOYAL, ONE_TIME), frozen.model())
    got = spark.read.parquet(out)
    assert got.count() == 2 and got.exceptAll(expected).count() == 0
    assert [(r["customer_id"], r["violations"]) for r in spark.read.parquet(bad).collect()] == [
        (3, ["recency_days"])]
    assert files.row_count(got).first()[0] == 2


def test_both_outputs_from_one_stream_survive_a_repeated_batch(spark, tmp_path):
    import os

    inbox, good, bad, state = (str(tmp_path / n) for n in ("in", "good", "bad", "state"))
    broken = changed(LOYAL, customer_id=3, recency_days=-1.0)
    rows(spark, LOYAL, broken).write.parquet(inbox)

    def run():
        stream = streaming.read_feature_stream(spark, inbox)
        streaming.start_both(stream, frozen.model(), good, bad, state).awaitTermination()

    def ids(folder):
        return sorted(r.customer_id for r in streaming.read_batches(spark, folder).collect())

    run()
    first = (ids(good), ids(bad))
    assert first == ([1], [3])
    # The batch was written but its end was not recorded: it comes again.
    for name in os.listdir(f"{state}/commits"):
        os.remove(f"{state}/commits/{name}")
    run()
    assert (ids(good), ids(bad)) == first
    rows(spark, ONE_TIME).write.mode("append").parquet(inbox)
    run()
    expected = scoring.predict(rows(spark, LOYAL, ONE_TIME), frozen.model())
    got = streaming.read_batches(spark, good)
    assert got.count() == 2 and got.exceptAll(expected).count() == 0
    assert [(r["customer_id"], r["violations"]) for r in streaming.read_batches(spark, bad).collect()] == [
        (3, ["recency_days"])]
