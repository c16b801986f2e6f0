"""Cross-validated training, and the newest saved model found by its files."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml, split


def labelled(spark, n=60):
    return spark.range(n).select("id", (F.col("id") % 6).cast("double").alias("x"), F.when(F.col("id") % 6 > 2, "hi").otherwise("lo").alias("y"))


def test_every_row_is_predicted_once_by_a_model_that_did_not_see_it(spark):
    df = split.assign_folds(labelled(spark), "y", ["id"], k=3)
    # a value that occurs in one fold only: its own model has never seen its class
    odd = df.withColumn("y", F.when(F.col("fold") == 1, F.lit("only")).otherwise(F.col("y")))
    cfg = {"model_type": "random_forest", "model_params": {"n_estimators": 3, "max_depth": 3}}
    cv = ml.cross_validate(cfg, odd, "y", ["x"], keep=["id"])
    rows = cv.predictions.collect()
    assert sorted(r.id for r in rows) == list(range(60))
    assert all(r.prediction != "only" for r in rows if r.fold == 1)
    whole = ml.cross_validate(cfg, df, "y", ["x"], keep=["id"])
    assert all(r.prediction == r.y for r in whole.predictions.collect())
    got = {(r.fold, r.metric): r.value for r in whole.metrics.collect()}
    assert {f for f, _ in got} == {0, 1, 2} and all(got[f, "accuracy"] == 1.0 for f in range(3))


def test_rows_without_fold_or_label_take_no_part(spark):
    rows = [(i, float(i % 2), "ab"[i % 2], i % 2 if i < 12 else i // 2 % 2) for i in range(16)] + [(90, 1.0, None, 0), (91, 1.0, "a", None)]
    df = spark.createDataFrame(rows, "id int, `x.1` double, y string, fold int")
    cv = ml.cross_validate({"model_type": "linear", "task_type": "classification"}, df.withColumn("fold", F.floor(F.col("id") / 2) % 2 + F.col("fold") * 0), "y", ["x.1"], keep=["id"])
    assert sorted(r.id for r in cv.predictions.collect()) == list(range(16))
    with pytest.raises(ValueError):
        ml.cross_validate({}, df.where("fold = 0"), "y", ["x.1"])
    with pytest.raises(ValueError):
        ml.cross_validate({}, df.limit(0), "y", ["x.1"])


def test_newest_model_is_the_last_that_was_saved_whole(spark, tmp_out):
    with pytest.raises(ValueError):
        ml.newest_saved_model(spark, f"{tmp_out}/none")
    cfg = {"model_type": "linear", "task_type": "regression"}
    df = labelled(spark).select("x", (F.col("x") * 2).alias("z"))
    for name, version in (("a", "10"), ("b", "1"), ("a", "9")):
        ml.save_model(ml.ModelTrainer(cfg).train(df, "z"), f"{tmp_out}/{name}/{version}")
    spark.range(1).write.parquet(f"{tmp_out}/_versions/x")
    ml.ModelTrainer(cfg).train(df, "z").model.write().save(f"{tmp_out}/a/11/model")  # not finished: no meta
    trained, info = ml.newest_saved_model(spark, tmp_out)
    assert (info["name"], info["version"], trained.label) == ("a", "9", "z")
    assert ml.newest_saved_model(spark, tmp_out, "b")[1]["version"] == "1"
    with pytest.raises(ValueError):
        ml.newest_saved_model(spark, tmp_out, "c")


def test_ranks_within_a_label_need_no_shuffle_by_the_label(spark, monkeypatch):
    df = labelled(spark, 2400)
    folds = split.assign_folds(df, "y", ["id"], k=3)
    assert "SortMergeJoin" not in folds._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(split, "BROADCAST_LABELS", 1, raising=False)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, split.assign_folds(df, "y", ["id"], k=3).collect()))
