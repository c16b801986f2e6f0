"""Model evaluation metrics over a (label, prediction) table.

Classification metrics come from the confusion table (one grouped job whose
output has at most classes^2 rows); regression metrics from one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol

CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1")
REGRESSION_METRICS = ("mse", "rmse", "mae", "r2")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(qcol(label).alias("label"), qcol(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def _same_type(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction) cast to one type, so that a class has one name in
    both: doubles where either side is a number of another kind, else text."""
    types = [df.select(qcol(c)).schema[0].dataType for c in (label, prediction)]
    both = [qcol(label).alias("label"), qcol(prediction).alias("prediction")]
    if types[0] != types[1]:
        kind = "double" if all(isinstance(t, T.NumericType) for t in types) else "string"
        both = [c.cast(kind).alias(n) for c, n in zip(both, ("label", "prediction"))]
    return df.select(*both)


def _metric_rows(df: DataFrame, values: dict, wanted) -> DataFrame:
    names = [m for m in values if m in wanted]
    if not names:
        return df.sparkSession.createDataFrame([], "metric string, value double")
    wide = df.select(*[values[m].alias(m) for m in names])
    return wide.unpivot([], names, "metric", "value")


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           metrics=None) -> DataFrame:
    """(metric, value): accuracy and support-weighted precision, recall and F1
    over the classes seen in either column; an undefined per-class precision
    or F1 counts as 0. Accuracy is computed when listed or when the list is
    empty; unknown names are ignored."""
    wanted = set(metrics or []) or {"accuracy"}
    if not metrics:
        wanted = {"accuracy"}
    cm = confusion(_same_type(df, label, prediction))
    # Each confusion cell adds to its true class (support, true positives) and
    # to its predicted class (predicted count): one pass over the cells.
    cell = F.explode(F.array(
        F.struct(F.col("label").cast("string").alias("cls"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").cast("string").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp"))))
    per = cm.select(cell.alias("c")).groupBy(F.col("c.cls").alias("cls")).agg(
        *[F.sum(f"c.{k}").cast("double").alias(k) for k in ("support", "predicted", "tp")])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    agg = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.sum(F.col("support") * prec).alias("wp"), F.sum(F.col("support") * rec).alias("wr"),
        F.sum(F.col("support") * f1).alias("wf"))
    n = F.col("n")
    values = {
        "accuracy": F.try_divide(F.col("tp"), n),
        "precision": F.try_divide(F.col("wp"), n),
        "recall": F.try_divide(F.col("wr"), n),
        "f1": F.try_divide(F.col("wf"), n),
    }
    return _metric_rows(agg, values, wanted)


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       metrics=None) -> DataFrame:
    """(metric, value): MSE, RMSE, MAE, R^2 (1 - SSE/SST; with SST = 0 it is
    1 for a perfect fit and 0 otherwise). MSE is computed when listed or when
    the list is empty."""
    wanted = set(metrics or []) or {"mse"}
    y, yh = qcol(label).cast("double"), qcol(prediction).cast("double")
    agg = df.agg(F.avg(F.pow(y - yh, 2)).alias("mse"), F.avg(F.abs(y - yh)).alias("mae"),
                 F.sum(F.pow(y - yh, 2)).alias("sse"),
                 (F.var_pop(y) * F.count(y)).alias("sst"))
    r2 = (F.when(F.col("sst") != 0, 1 - F.col("sse") / F.col("sst"))
          .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    values = {"mse": F.col("mse"), "rmse": F.sqrt("mse"), "mae": F.col("mae"), "r2": r2}
    return _metric_rows(agg, values, wanted)


def evaluate(df: DataFrame, task_type: str = "classification", label: str = "label",
             prediction: str = "prediction", metrics=None) -> DataFrame:
    if task_type == "classification":
        return classification_metrics(df, label, prediction, metrics)
    return regression_metrics(df, label, prediction, metrics)


def as_dict(metric_rows: DataFrame) -> dict[str, float]:
    """Collect a (metric, value) table; bounded by the number of metrics."""
    return {r["metric"]: r["value"] for r in metric_rows.collect()}


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """One row (auc, n_pos, n_neg): exact area under the ROC curve of
    ``score`` for ``label == positive`` (Mann-Whitney rank sum, ties half).
    Scores are counted per distinct value (one shuffle) and scanned in
    sorted runs; no single task holds all scores."""
    from tidemark.operators.ordered import rank_auc
    is_pos = (qcol(label) == F.lit(positive)).cast("long")
    counts = (df.where(qcol(score).isNotNull() & qcol(label).isNotNull())
              .groupBy(F.lit("score").alias("column"), qcol(score).cast("double").alias("value"))
              .agg(F.sum(is_pos).alias("n_pos"), F.sum(1 - is_pos).alias("n_neg")))
    return rank_auc(counts).select("auc", F.col("n_pos").cast("long"), F.col("n_neg").cast("long"))
