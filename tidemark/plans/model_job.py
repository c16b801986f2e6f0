"""Config-driven model run: split -> train -> evaluate (validation and test)
-> save -> log metrics and parameters -> results."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import metrics as M
from tidemark.operators import ml, runs, split
from tidemark.session import scratch_path


def _load_config(config: str | dict) -> dict:
    if isinstance(config, dict):
        return config
    return json.loads(Path(config).read_text())


class ModelPipeline:
    """``train / predict / evaluate`` on DataFrames, and ``run(df, target)``
    for the whole flow. Config may be flat or nested (``trainer``,
    ``evaluator``); ``test_size`` (0.2), ``random_state`` (42),
    ``split_keys`` (default: all feature columns), ``model_dir`` (models go to
    ``<model_dir>/<model_name>/<version>``), ``versions_path`` (model-version
    table, by default in ``model_dir``), ``stage``,
    ``metrics_path`` and ``params_path`` (run-history tables), ``model_name``."""

    def __init__(self, spark: SparkSession, config: dict | None = None):
        self.spark = spark
        self.config = dict(config or {})
        self.trainer = ml.ModelTrainer(self.config)
        ev = ml.evaluator_config(self.config)
        self.task_type = self.trainer.task_type
        default = ["accuracy"] if self.task_type == "classification" else ["mse"]
        self.metrics = ev.get("metrics", default)
        self.test_size = float(self.config.get("test_size", 0.2))
        self.random_state = int(self.config.get("random_state", 42))

    # -- the three calls a user makes directly
    def train(self, df: DataFrame, target: str, features: list[str] | None = None) -> ml.TrainedModel:
        return self.trainer.train(df, target, features)

    def predict(self, df: DataFrame) -> DataFrame:
        if self.trainer.trained is None:
            raise ValueError("no trained model to predict with")
        return ml.predict(self.trainer.trained, df)

    def evaluate(self, df: DataFrame) -> dict[str, float]:
        if self.trainer.trained is None:
            raise ValueError("no trained model to evaluate")
        return M.as_dict(ml.evaluate(self.trainer.trained, df, self.metrics))

    # -- the whole flow
    def run(self, df: DataFrame, target: str) -> dict:
        if target not in df.columns:
            target = df.columns[-1]  # fall back to the last column, as published runners do
        features = [c for c in df.columns if c != target]
        keys = list(self.config.get("split_keys", features + [target]))
        # The tagged table feeds the fit and both evaluations: written once, read by each.
        path = scratch_path(self.spark, "model-split")
        ml.balanced(split.assign_split(df, keys, self.test_size, self.random_state)).write.parquet(path)
        tagged = self.spark.read.parquet(path)
        parts = {s: tagged.where(tagged["split"] == s).drop("split") for s in ("train", "validation", "test")}
        trained = self.train(parts["train"], target, features)
        val_metrics = M.as_dict(ml.evaluate(trained, parts["validation"], self.metrics))
        test_metrics = M.as_dict(ml.evaluate(trained, parts["test"], self.metrics))
        run_id = uuid.uuid4().hex
        results = {"model_type": self.trainer.model_type, "val_metrics": val_metrics,
                   "test_metrics": test_metrics, "run_id": run_id}
        name = self.config.get("model_name", f"{self.trainer.model_type}_model")
        if self.config.get("model_dir"):
            # saved and registered where ml.load_registered_model looks for it
            root = self.config["model_dir"]
            versions = self.config.get("versions_path", f"{root}/_versions")
            version = runs.reserve_version(self.spark, versions, name)
            results |= {"model_path": ml.save_model(trained, f"{root}/{name}/{version}"), "model_version": version}
            runs.register_version(self.spark, versions, name, version, self.config.get("stage", "None"), run_id)
        if self.config.get("metrics_path"):
            logged = {**val_metrics, **{f"test_{k}": v for k, v in test_metrics.items()}}
            runs.log_metrics(self.spark, self.config["metrics_path"], name, logged, run_id=run_id)
        if self.config.get("params_path"):
            runs.log_params(self.spark, self.config["params_path"], run_id, self.trainer.model_params)
        return results


def create_model_pipeline(spark: SparkSession, config: str | dict) -> ModelPipeline:
    return ModelPipeline(spark, _load_config(config))


def run_all(spark: SparkSession, data_config: str | dict, model_config: str | dict, target: str) -> dict:
    """Data run, then model run on its written output; one merged metadata record."""
    from tidemark.plans.data_job import create_data_pipeline
    processed, meta = create_data_pipeline(spark, data_config).run()
    results = create_model_pipeline(spark, model_config).run(processed, target)
    return {**meta, "model_results": results}
