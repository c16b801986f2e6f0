"""Run history and model versions as tables.

``run_metrics(run_id, model, metric, step, value, ts)`` holds logged metrics
and parameters; ``model_versions(name, version, stage, run_id)`` holds
registered versions. Latest-per-key lookups are grouped ``max_by``
aggregates, which combine map-side, so one model with a third of all rows
does not land in a single task."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

RUN_METRICS_SCHEMA = ("run_id string, model string, metric string, step long, "
                      "value double, ts timestamp")
MODEL_VERSIONS_SCHEMA = "name string, version long, stage string, run_id string"


def log_metrics(spark: SparkSession, path: str, model: str, metrics: dict[str, float],
                step: int | None = None, run_id: str | None = None) -> str:
    """Append one row per metric to the run-metrics table, partitioned by model."""
    run_id = run_id or uuid.uuid4().hex
    rows = [(run_id, model, k, step, float(v)) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "run_id string, model string, metric string, step long, value double")
    df.withColumn("ts", F.current_timestamp()).write.mode("append").partitionBy("model").parquet(path)
    return run_id


def log_params(spark: SparkSession, path: str, run_id: str, params: dict) -> None:
    """Append (run_id, param, value) rows."""
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "run_id string, param string, value string") \
        .write.mode("append").parquet(path)


def latest_metrics(run_metrics: DataFrame) -> DataFrame:
    """(model, metric, last_step, last_value, n_points): the value at the
    highest step per (model, metric); a logged value without a step comes
    before those with one. Ties, and values without steps, go to the latest
    ``ts`` (where the table has one), then to the largest value."""
    order = [F.coalesce(F.col("step"), F.lit(-(1 << 62)))]
    if "ts" in run_metrics.columns:
        order.append(F.coalesce(F.col("ts").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")))
    last = F.max(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("value").alias("value")))
    return run_metrics.groupBy("model", "metric").agg(
        F.max("step").alias("last_step"), last.alias("_last"),
        F.count(F.lit(1)).alias("n_points")).select(
        "model", "metric", "last_step", F.col("_last.value").alias("last_value"), "n_points")


def latest_versions(model_versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Highest version per (name, stage), optionally for one stage:
    (name, stage, version, run_id)."""
    mv = model_versions
    if stage is not None:
        mv = mv.where(F.col("stage") == stage)
    best = mv.groupBy("name", "stage").agg(
        F.max(F.struct("version", "run_id")).alias("b"))  # equal versions: the largest run_id
    return best.select("name", "stage", F.col("b.version").alias("version"),
                       F.col("b.run_id").alias("run_id"))


def latest_version(model_versions: DataFrame, name: str, stage: str | None = None) -> dict | None:
    """The newest version of one model (any stage unless given), or None."""
    mv = model_versions.where(F.col("name") == name)
    if stage is not None:
        mv = mv.where(F.col("stage") == stage)
    row = mv.agg(F.max(F.struct("version", "run_id", "stage", "name")).alias("b")).first()
    if row is None or row["b"] is None:
        return None
    b = row["b"].asDict()
    b["uri"] = f"models:/{b['name']}/{b['version']}"
    return b


def latest_baseline(baselines: DataFrame) -> DataFrame:
    """Active baseline: (metric, value) at the latest ``as_of`` stamp."""
    top = baselines.agg(F.max("as_of").alias("_top"))
    return baselines.join(F.broadcast(top), F.col("as_of") == F.col("_top")).select("metric", "value")


def next_version(spark: SparkSession, path: str, name: str) -> int:
    """One more than the highest registered version of ``name`` (1 at first)."""
    from pyspark.errors import AnalysisException
    try:
        row = spark.read.schema(MODEL_VERSIONS_SCHEMA).parquet(path).where(F.col("name") == name).agg(F.max("version")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1
    return (row[0] or 0) + 1


def reserve_version(spark: SparkSession, path: str, name: str) -> int:
    """A version of ``name`` that no other caller gets, without a lock: the next
    free number is claimed by creating its file under ``<path>/_claims``, and
    whoever comes second tries the number after it. Callers that all register what
    they reserve leave no gap; a caller that dies in between leaves its number
    unused."""
    folder = f"{path}/_claims/{quote('m ' + name, safe='')}"
    taken = max((int(n) for n in files.names(spark, folder) if n.isdigit()), default=0)
    version = max(taken + 1, next_version(spark, path, name))
    while not files.claim(spark, f"{folder}/{version}"):
        version += 1
    return version


def register_version(spark: SparkSession, path: str, name: str, version: int, stage: str = "None",
                     run_id: str | None = None) -> None:
    """Add one (name, version, stage, run_id) row to the model-version table. The
    row is written aside and its file renamed into the table: appending jobs share
    a temporary folder, and the first to end would delete the others' rows."""
    aside = f"{path}/_staging/{uuid.uuid4().hex}"
    spark.createDataFrame([(name, int(version), stage, run_id)], MODEL_VERSIONS_SCHEMA).coalesce(1).write.parquet(aside)
    for part in files.names(spark, aside):
        if part.startswith("part-"):
            files.move(spark, f"{aside}/{part}", f"{path}/{part}")
    files.delete(spark, aside)


def register_next(spark: SparkSession, path: str, name: str, stage: str = "None", run_id: str | None = None) -> int:
    """Reserve a version of ``name`` and register it; returns the version."""
    version = reserve_version(spark, path, name)
    register_version(spark, path, name, version, stage, run_id)
    return version
