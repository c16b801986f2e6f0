"""Sinks: processed tables, run metadata, metric baselines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a processed table: a directory of part files. CSV gets a header,
    doubles a quote inside a cell and keeps blanks at a cell's edges."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        (writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)
    return path


def append_run_metadata(spark: SparkSession, path: str, run_id: str, record: dict) -> None:
    """Append one row per run to a metadata table: (run_id, recorded_at,
    metadata JSON text)."""
    row = spark.createDataFrame([(run_id, json.dumps(record, default=str, sort_keys=True))],
                                "run_id string, metadata string")
    row.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)


def save_metrics_as_baseline(metrics: DataFrame, path: str, as_of: str | None = None) -> str:
    """Append (metric, value) rows to a baseline table with an ``as_of``
    stamp; the active baseline is the latest stamp (see runs.latest_baseline)."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    (metrics.select(F.col("metric").cast("string"), F.col("value").cast("double"))
     .withColumn("as_of", stamp).write.mode("append").parquet(path))
    return path
