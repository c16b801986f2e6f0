import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.operators import ml, prep, runs
from tidemark.plans.data_job import create_data_pipeline
from tidemark.plans.model_job import create_model_pipeline
from tidemark.sources.sample import sample_table

MODEL_CONFIG = {"model_type": "random_forest", "task_type": "classification",
                "model_params": {"n_estimators": 10, "max_depth": 5},
                "metrics": ["accuracy", "precision", "recall", "f1"]}


@pytest.fixture(scope="module")
def sample(spark):
    return sample_table(spark, 100, 42).cache()


def _features(spark, sample):
    x, _ = prep.fit_transform(sample.drop("id"), [{"type": "encode_categorical", "columns": ["category"],
                                                  "method": "one_hot"}])
    return x


def test_model_pipeline_creation(spark):
    p = create_model_pipeline(spark, MODEL_CONFIG)
    assert hasattr(p, "train") and hasattr(p, "predict") and hasattr(p, "evaluate")


def test_model_pipeline_execution(spark, sample):
    x = _features(spark, sample)
    p = create_model_pipeline(spark, MODEL_CONFIG)
    p.train(x, "target")
    preds = p.predict(x)
    assert preds.count() == 100
    m = p.evaluate(x)
    assert set(m) == {"accuracy", "precision", "recall", "f1"}
    assert 0.5 <= m["accuracy"] <= 1.0


def test_predictions_keep_label_values_and_probabilities(spark):
    df = spark.createDataFrame([(float(i), "hi" if i > 5 else "lo") for i in range(12)], "x double, y string")
    t = ml.ModelTrainer({"model_type": "linear"}).train(df, "y")
    out = ml.predict(t, df).collect()
    assert {r["prediction"] for r in out} <= {"hi", "lo"}
    assert all(len(r["probability"]) == 2 for r in out)


@pytest.mark.parametrize("model_type,task", [("random_forest", "regression"), ("gradient_boosting", "classification"),
                                             ("gradient_boosting", "regression"), ("linear", "regression")])
def test_other_estimators_train(spark, sample, model_type, task):
    x = _features(spark, sample)
    t = ml.ModelTrainer({"model_type": model_type, "task_type": task,
                         "model_params": {} if model_type == "linear" else {"n_estimators": 5}}).train(x, "target")
    assert ml.predict(t, x).count() == 100


def test_multiclass_boosting_has_probabilities(spark, tmp_out):
    df = spark.range(600).select((F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("noise"),
                                 F.element_at(F.array(*[F.lit(v) for v in "abc"]), (F.col("id") % 3 + 1).cast("int")).alias("y"))
    t = ml.ModelTrainer({"model_type": "gradient_boosting", "model_params": {"n_estimators": 3}}).train(df, "y")
    rows = ml.predict(t, df).collect()
    assert all(r["prediction"] == r["y"] for r in rows)
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and max(r["probability"]) == r["probability"]["abc".index(r["y"])] for r in rows)
    back = ml.load_model(spark, ml.save_model(t, f"{tmp_out}/boosted"))
    again = ml.predict(back, df).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_boosting_follows_newton_steps(spark):
    """One feature of three values, one split a value: every row's scores are
    those of Newton boosting by hand."""
    import math
    n, rounds, step = {(0, 0): 30, (0, 1): 10, (1, 1): 20, (1, 2): 20, (2, 2): 40}, 4, 0.3
    rows = [(float(x), y) for (x, y), c in n.items() for _ in range(c)]
    df = spark.createDataFrame(rows, "x double, y int")
    t = ml.ModelTrainer({"model_type": "gradient_boosting", "model_params": {"n_estimators": rounds, "learning_rate": step, "max_depth": 2}}).train(df, "y")
    share = [sum(c for (_, y), c in n.items() if y == k) / len(rows) for k in range(3)]
    score = {x: [math.log(s) for s in share] for x in range(3)}
    for _ in range(rounds):
        p = {x: [math.exp(s) / sum(map(math.exp, v)) for s in v] for x, v in score.items()}
        for x in range(3):
            for k in range(3):
                h = p[x][k] * (1 - p[x][k])
                z = [(c, max(-4.0, min(4.0, ((y == k) - p[x][k]) / h))) for (a, y), c in n.items() if a == x]
                score[x][k] += step * 2 / 3 * sum(c * v for c, v in z) / sum(c for c, _ in z)
    for r in ml.predict(t, df).select("x", "probability").distinct().collect():
        v = score[int(r["x"])]
        assert r["probability"] == pytest.approx([math.exp(s) / sum(map(math.exp, v)) for s in v], abs=1e-6)


def test_unknown_model_type():
    with pytest.raises(ValueError):
        ml.ModelTrainer({"model_type": "svm"})


def test_save_load_and_score(spark, sample, tmp_out):
    x = _features(spark, sample)
    trainer = ml.ModelTrainer(MODEL_CONFIG)
    with pytest.raises(ValueError):
        trainer.save_model(tmp_out)
    t = trainer.train(x, "target")
    trainer.save_model(f"{tmp_out}/m")
    back = ml.load_model(spark, f"{tmp_out}/m")
    a = [r["prediction"] for r in ml.predict(t, x).orderBy("feature1").collect()]
    b = [r["prediction"] for r in ml.predict(back, x).orderBy("feature1").collect()]
    assert a == b
    scored = ml.score_batch(back, x, "m", "3").first()
    assert scored["batch_size"] == 100 and scored["model_name"] == "m" and scored["model_version"] == "3"


def test_end_to_end_csv_pipeline(spark, sample, tmp_out):
    src = f"{tmp_out}/raw"
    sample.write.option("header", True).csv(src)
    cfg = {"input_path": src, "output_path": f"{tmp_out}/processed",
           "validation_schema": {"dtypes": {"feature1": "float64", "target": "int64"}},
           "preprocessing_steps": [{"type": "drop_duplicates"},
                                   {"type": "encode_categorical", "columns": ["category"]},
                                   {"type": "scale_numerical", "columns": ["feature1", "feature2"]}]}
    dp = create_data_pipeline(spark, cfg)
    assert dp.config == cfg
    processed, meta = dp.run()
    assert meta["raw_shape"] == (100, 5) and meta["is_valid"]
    assert dict(processed.dtypes)["category"] == "double"
    mp = create_model_pipeline(spark, {**MODEL_CONFIG, "metrics_path": f"{tmp_out}/runs",
                                       "model_dir": f"{tmp_out}/models"})
    res = mp.run(processed.drop("id"), "target")
    assert "accuracy" in res["val_metrics"] and "accuracy" in res["test_metrics"]
    hist = runs.latest_metrics(spark.read.parquet(f"{tmp_out}/runs"))
    assert {r["metric"] for r in hist.collect()} >= {"accuracy", "test_accuracy"}


def test_validation_gate(spark, tmp_out):
    src = f"{tmp_out}/dups"
    spark.createDataFrame([(1, 2.0), (1, 2.0)], "a long, b double").write.option("header", True).csv(src)
    with pytest.raises(ValueError):
        create_data_pipeline(spark, {"input_path": src}).run()
    _, meta = create_data_pipeline(spark, {"input_path": src, "force_continue": True,
                                           "metadata_path": f"{tmp_out}/meta"}).run()
    assert meta["validation_results"]["duplicate_rows"] == 1
    assert spark.read.parquet(f"{tmp_out}/meta").count() == 1


def test_baseline_sink_latest(spark, tmp_out):
    from tidemark.sources.writers import save_metrics_as_baseline
    m1 = spark.createDataFrame([("acc", 0.8)], "metric string, value double")
    m2 = spark.createDataFrame([("acc", 0.9), ("f1", 0.7)], "metric string, value double")
    save_metrics_as_baseline(m1, f"{tmp_out}/b", as_of="2024-01-01 00:00:00")
    save_metrics_as_baseline(m2, f"{tmp_out}/b", as_of="2024-02-01 00:00:00")
    got = {r["metric"]: r["value"] for r in runs.latest_baseline(spark.read.parquet(f"{tmp_out}/b")).collect()}
    assert got == {"acc": 0.9, "f1": 0.7}


def test_latest_versions(spark):
    mv = spark.createDataFrame([("m", 1, "Staging", "r1"), ("m", 3, "Staging", "r3"), ("m", 2, "Production", "r2")],
                               runs.MODEL_VERSIONS_SCHEMA)
    got = {(r["stage"], r["version"]) for r in runs.latest_versions(mv).collect()}
    assert got == {("Staging", 3), ("Production", 2)}
    assert runs.latest_version(mv, "m")["version"] == 3
    assert runs.latest_version(mv, "m", "Production")["run_id"] == "r2"
    assert runs.latest_version(mv, "other") is None


def test_metrics_json_reader(spark, tmp_out):
    from tidemark.sources.readers import read_metrics
    p = f"{tmp_out}/base.json"
    with open(p, "w") as f:
        json.dump({"accuracy": 0.9, "f1": 1}, f)
    got = {r["metric"]: r["value"] for r in read_metrics(spark, p).collect()}
    assert got == {"accuracy": 0.9, "f1": 1.0}


def test_registered_model_roundtrip(spark, sample, tmp_out):
    x = _features(spark, sample)
    t = ml.ModelTrainer(MODEL_CONFIG).train(x, "target")
    for v in (1, 2):
        ml.save_model(t, f"{tmp_out}/models/m/{v}")
        runs.register_version(spark, f"{tmp_out}/versions", "m", v, "Staging" if v == 2 else "None", f"r{v}")
    mv = spark.read.parquet(f"{tmp_out}/versions")
    model, info = ml.load_registered_model(spark, mv, "m", f"{tmp_out}/models")
    assert info["version"] == 2 and model.features == t.features
    with pytest.raises(ValueError):
        ml.load_registered_model(spark, mv, "m", f"{tmp_out}/models", stage="Production")


def test_score_request_payload_shapes(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), "hi" if i > 5 else "lo") for i in range(12)],
                               "a double, b double, y string")
    t = ml.ModelTrainer({"model_type": "linear"}).train(df, "y", ["a", "b"])
    out = ml.score_request(spark, t, [[1.0, 0.0], [9.0, 1.0]], "m", "1").collect()
    assert len(out) == 2 and out[0]["batch_size"] == 2
    one = ml.score_request(spark, t, {"b": 1.0, "a": 10.0}, "m").first()
    assert one["prediction"] in ("hi", "lo") and len(one["probability"]) == 2
    with pytest.raises(ValueError):
        ml.request_frame(spark, t, {"a": 1.0})


def test_factories_accept_json_paths(spark, tmp_out):
    p = f"{tmp_out}/data.json"
    with open(p, "w") as f:
        json.dump({"input_path": "x.csv", "preprocessing_steps": [{"type": "drop_duplicates"}]}, f)
    assert create_data_pipeline(spark, p).config["input_path"] == "x.csv"
    q = f"{tmp_out}/model.json"
    with open(q, "w") as f:
        json.dump({"trainer": {"model_type": "gradient_boosting", "task_type": "regression"},
                   "evaluator": {"metrics": ["mse", "r2"]}}, f)
    mp = create_model_pipeline(spark, q)
    assert mp.trainer.model_type == "gradient_boosting" and mp.metrics == ["mse", "r2"]


def test_log_metrics_and_params_tables(spark, tmp_out):
    rid = runs.log_metrics(spark, f"{tmp_out}/m", "model_a", {"accuracy": 0.8}, step=1)
    runs.log_metrics(spark, f"{tmp_out}/m", "model_a", {"accuracy": 0.9}, step=2, run_id=rid)
    runs.log_params(spark, f"{tmp_out}/p", rid, {"n_estimators": 10, "max_depth": 5})
    last = runs.latest_metrics(spark.read.parquet(f"{tmp_out}/m")).first()
    assert (last["model"], last["last_step"], last["last_value"], last["n_points"]) == ("model_a", 2, 0.9, 2)
    params = {r["param"]: r["value"] for r in spark.read.parquet(f"{tmp_out}/p").collect()}
    assert params == {"n_estimators": "10", "max_depth": "5"}


def test_sample_table_shape_and_determinism(spark):
    a = sample_table(spark, 200, 7)
    b = sample_table(spark, 200, 7)
    assert a.columns == ["id", "feature1", "feature2", "category", "target"]
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    cats = {r["category"] for r in a.select("category").distinct().collect()}
    assert cats <= {"A", "B", "C"} and {r["target"] for r in a.select("target").distinct().collect()} <= {0, 1}


def test_unknown_hyperparameters_are_errors(spark, sample):
    x = _features(spark, sample)
    with pytest.raises(ValueError, match="no hyperparameter subsample, trees"):
        ml.ModelTrainer({"model_type": "random_forest", "model_params": {"trees": 3, "subsample": 0.5}}).train(x, "target")
    ml.ModelTrainer({"model_type": "linear", "model_params": {"penalty": "elasticnet", "l1_ratio": 0.5, "n_jobs": 4}}).train(x, "target")


def test_run_registers_what_the_loader_finds(spark, sample, tmp_out):
    x = _features(spark, sample)
    cfg = {"model_type": "linear", "model_params": {}, "model_dir": f"{tmp_out}/m", "metrics_path": f"{tmp_out}/h", "model_name": "clf"}
    for version in (1, 2):
        out = create_model_pipeline(spark, cfg).run(x, "target")
        assert out["model_version"] == version and out["model_path"].endswith(f"/clf/{version}")
    trained, info = ml.load_registered_model(spark, spark.read.parquet(f"{tmp_out}/m/_versions"), "clf", f"{tmp_out}/m")
    assert info["version"] == 2 and ml.score_batch(trained, x, "clf", "2").count() == x.count()
    last = runs.latest_metrics(spark.read.parquet(f"{tmp_out}/h")).collect()
    assert last and all(r["last_value"] is not None and r["n_points"] == 2 for r in last)


def test_feature_names_may_hold_dots(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), i % 2) for i in range(40)], "`a.b` double, `c` double, `y.z` int")
    t = ml.ModelTrainer({"model_type": "random_forest", "model_params": {"n_estimators": 2, "max_depth": 2}}).train(df, "y.z")
    assert ml.predict(t, df).count() == 40
    assert M.as_dict(ml.evaluate(t, df, ["accuracy", "f1"])).keys() == {"accuracy", "f1"}


def test_class_numbers_leave_rows_where_they_are(spark):
    """A shuffle by the class would leave a fit as many partitions as there are classes."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        df = spark.range(4800).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("y"))
        kept = ml.balanced(df).persist()
        assert ml._index_label(kept, "y", ["a", "b"]).rdd.getNumPartitions() == 24
        kept.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = ml._index_label(spark.createDataFrame([("a",), ("b",), (None,)], "y string"), "y", ["a", "b"]).collect()
    assert {(r.y, r._label_idx) for r in rows} == {("a", 0.0), ("b", 1.0), (None, None)}


def test_partitions_of_a_fit_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ml, "PARTITION_ROWS", 100, raising=False)
    assert ml.balanced(spark.range(4800)).rdd.getNumPartitions() == 48
    assert ml.balanced(spark.range(10)).rdd.getNumPartitions() == 4
