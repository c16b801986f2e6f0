"""Config-driven data preparation run: load -> validate -> gate ->
prepare -> write -> metadata."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import prep, quality
from tidemark.session import scratch_path
from tidemark.sources import readers, writers


def _load_config(config: str | dict) -> dict:
    if isinstance(config, dict):
        return config
    return json.loads(Path(config).read_text())


class DataPipeline:
    """``DataPipeline(spark, config).run() -> (prepared DataFrame, metadata)``.

    Config keys: ``ingestion`` {source_type, source_path | input_path},
    top-level ``input_path`` (overrides), ``validation_schema`` {dtypes},
    ``preprocessing`` {preprocessing_steps} or top-level
    ``preprocessing_steps``, ``output_path``, ``output_format`` (csv default,
    parquet, json), ``force_continue``, ``metadata_path`` (run-metadata table,
    one row appended per run), ``fitted_path`` (fitted step statistics, for
    transforming later data with ``prep.load_fitted`` + ``prep.transform``)."""

    def __init__(self, spark: SparkSession, config: dict):
        self.spark = spark
        self.config = config
        ingestion = dict(config.get("ingestion", {}) or {})
        if config.get("input_path"):
            ingestion["input_path"] = config["input_path"]
        if not ingestion.get("source_path") and config.get("data_source"):
            ingestion["source_path"] = config["data_source"]
        self.ingestion = ingestion
        self.schema = config.get("validation_schema")
        self.preprocessor = prep.DataPreprocessor(config)

    def load(self) -> DataFrame:
        return readers.read_table(self.spark, self.ingestion)

    def run(self) -> tuple[DataFrame, dict]:
        raw = self.load()
        result = quality.validate(raw, self.schema)
        if not result.is_valid and not self.config.get("force_continue", False):
            raise ValueError("the input has duplicate rows or undeclared types; set force_continue to prepare it anyway")
        processed = self.preprocessor.preprocess(raw)
        # Written once and read back: neither the count nor a caller computes it again.
        kept = scratch_path(self.spark, "prepared")
        processed.write.parquet(kept)
        processed = self.spark.read.parquet(kept)
        out = self.config.get("output_path")
        if out:
            writers.write_table(processed, out, fmt=self.config.get("output_format", "csv"))
        metadata = {
            "raw_shape": (result.n_rows, len(raw.columns)),
            "processed_shape": (processed.count(), len(processed.columns)),
            "validation_results": result.as_dict(),
            "is_valid": result.is_valid,
            "fitted_steps": self.preprocessor.fitted.describe() if self.preprocessor.fitted else None,
        }
        if self.config.get("fitted_path") and self.preprocessor.fitted is not None:
            prep.save_fitted(self.preprocessor.fitted, self.config["fitted_path"])
        if self.config.get("metadata_path"):
            import uuid
            writers.append_run_metadata(self.spark, self.config["metadata_path"], uuid.uuid4().hex, metadata)
        return processed, metadata


def create_data_pipeline(spark: SparkSession, config: str | dict) -> DataPipeline:
    """Factory from a JSON file path or a dict."""
    return DataPipeline(spark, _load_config(config))
