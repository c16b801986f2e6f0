import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.streaming import monitor


def test_daily_drift_across_batches_equals_one_shot(spark, tmp_out):
    rows = [(f"2024-01-0{d} 0{h}:00:00", t) for d in (1, 2) for h in range(6) for t in ("a", "b", "b")]
    df = spark.createDataFrame(rows, "ts string, kind string").select(
        F.to_timestamp("ts").alias("ts"), "kind")
    src = f"{tmp_out}/src"
    # day 2 arrives in two files (two micro-batches), the second one late
    df.where(F.hour("ts") < 3).coalesce(1).write.parquet(f"{src}/part1")
    df.where(F.hour("ts") >= 3).coalesce(1).write.parquet(f"{src}/part2")
    ref = spark.createDataFrame([("a",), ("a",), ("b",)], "kind string")
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    q = monitor.start_daily_drift(stream, ref, ["kind"], "ts", f"{tmp_out}/out", f"{tmp_out}/state",
                                  f"{tmp_out}/ckpt")
    q.awaitTermination()
    got = {(str(r["day"]), r["n_current"]): round(r["js_divergence"], 12)
           for r in spark.read.parquet(f"{tmp_out}/out").collect()}
    counts = df.select(F.to_date("ts").alias("day"), F.col("kind").alias("value")) \
        .groupBy("day", F.lit("kind").alias("column"), "value").agg(F.count(F.lit(1)).alias("n"))
    ref_path = monitor.write_reference_counts(ref, ["kind"], f"{tmp_out}/refc")
    want = {(str(r["day"]), r["n_current"]): round(r["js_divergence"], 12)
            for r in monitor.daily_js(spark, ref_path, counts).collect()}
    assert got == want and len(got) == 2


def test_scoring_on_arrival(spark, tmp_out):
    train = spark.range(40).select((F.col("id") % 4).cast("double").alias("x"),
                                   F.when(F.col("id") % 4 > 1, "hi").otherwise("lo").alias("y"))
    trained = ml.ModelTrainer({"model_type": "linear"}).train(train, "y")
    src = f"{tmp_out}/in"
    train.select("x").write.parquet(src)
    stream = spark.readStream.schema("x double").parquet(src)
    q = monitor.start_scoring(trained, stream, f"{tmp_out}/scored", f"{tmp_out}/ck", "m", "1", keep=["x"])
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_out}/scored")
    assert out.count() == 40
    assert {r["prediction"] for r in out.collect()} <= {"hi", "lo"}


def test_windowed_daily_drift_scores_open_days(spark, tmp_out):
    rows = [(f"2024-01-0{d} 0{h}:00:00", t) for d in (1, 2) for h in range(4) for t in ("a", "b", "b")]
    rows.append(("2024-01-09 00:00:00", "a"))  # advances the watermark past days 1 and 2; its own day stays open
    df = spark.createDataFrame(rows, "ts string, kind string").select(F.to_timestamp("ts").alias("ts"), "kind")
    src = f"{tmp_out}/src"
    df.where(F.dayofmonth("ts") < 9).coalesce(1).write.parquet(f"{src}/a")
    df.where(F.dayofmonth("ts") == 9).coalesce(1).write.parquet(f"{src}/b")
    ref = spark.createDataFrame([("a",), ("b",)], "kind string")
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    q = monitor.start_daily_drift_windowed(stream, ref, ["kind"], "ts", f"{tmp_out}/out", f"{tmp_out}/state",
                                           f"{tmp_out}/ckpt", watermark="1 hour")
    q.awaitTermination()
    got = {str(r["day"]): round(r["js_divergence"], 12) for r in spark.read.parquet(f"{tmp_out}/out").collect()}
    counts = df.select(F.to_date("ts").alias("day"), F.col("kind").alias("value")) \
        .groupBy("day", F.lit("kind").alias("column"), "value").agg(F.count(F.lit(1)).alias("n"))
    ref_path = monitor.write_reference_counts(ref, ["kind"], f"{tmp_out}/refc")
    want = {str(r["day"]): round(r["js_divergence"], 12) for r in monitor.daily_js(spark, ref_path, counts).collect()}
    assert got == want and set(got) == {"2024-01-01", "2024-01-02", "2024-01-09"}


@pytest.mark.parametrize("files", [1, 4, 16])
def test_windowed_and_table_state_agree_over_many_files(spark, tmp_out, files):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(files).write.parquet(f"{tmp_out}/src")
    ref = ev.where("event_id % 2 = 0")
    found = []
    for name, start in (("t", monitor.start_daily_drift), ("w", monitor.start_daily_drift_windowed)):
        base = f"{tmp_out}/{name}"
        q = start(spark.readStream.schema(ev.schema).parquet(f"{tmp_out}/src"), ref, ["event_type"], "ts",
                  f"{base}/out", f"{base}/state", f"{base}/ck")
        q.awaitTermination()
        found.append(sorted((str(r["day"]), round(r["js_divergence"], 9), r["n_current"])
                            for r in spark.read.parquet(f"{base}/out").collect()))
    assert found[0] == found[1] and sum(r[2] for r in found[0]) == ev.count()
