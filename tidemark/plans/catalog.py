"""Registered queries over the driver tables: each takes (spark, sf_dir) and
returns a DataFrame whose columns match the oracle SQL in ``oracle.py``.

Fixture rules shared with the oracle:
* derived NULLs: ``CASE WHEN <key> % 7 = 0 THEN NULL ELSE x END``;
* drift periods: events before / from 2024-01-15, lineitem before / from
  1998-01-01; induced drift by calling 'error' events 'purchase' or shifting a
  value on the current side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import round9
from tidemark.session import scratch_path
from tidemark.sources import readers, writers
from tidemark.operators import drift, metrics, ml, perf, prep, quality, runs, split
from tidemark.plans.data_job import create_data_pipeline
from tidemark.plans.model_job import create_model_pipeline, run_all
from tidemark.plans.monitor_job import run_monitoring
from tidemark.streaming import monitor

EVENTS_CUT = "2024-01-15 00:00:00"
SHIP_CUT = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read as a file stream, all present files in one trigger.
    Spark's own listing tells a folder of part files, which is streamed as is,
    from a single file, which is picked out of its folder by name."""
    whole = table(spark, sf_dir, name)
    files = whole.inputFiles()
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(whole.schema)
    if not (len(files) == 1 and files[0].endswith(f"/{name}.parquet")):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def null_every_7th(key: str, col: str) -> F.Column:
    return F.when(F.col(key) % 7 == 0, F.lit(None)).otherwise(F.col(col))


# ---------------------------------------------------------------- drift

def _events_sides(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    cur = ev.where(F.col("ts") >= F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    return ref, cur.withColumn("event_type", F.when(F.col("event_type") == "error", "purchase").otherwise(F.col("event_type")))


def q_drift_categorical(spark, sf_dir):
    ref, cur = _events_sides(spark, sf_dir)
    cols = ["event_type", "props"]
    out = drift.categorical_drift(ref.select(*cols), cur.select(*cols), cols)
    return out.select("column", "method", round9(F.col("js_divergence")).alias("js_divergence"),
                      "n_reference", "n_current", "drift_detected")


def _lineitem_sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit(SHIP_CUT).cast("timestamp_ntz")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ref = li.where(F.col("l_shipdate") < cut).select(*cols, F.col("l_discount").alias("l_discount_shift"))
    cur = li.where(F.col("l_shipdate") >= cut).select(
        *cols, (F.col("l_discount") + F.lit(0.01)).alias("l_discount_shift"))
    return ref, cur, cols + ["l_discount_shift"]


def q_drift_numeric_ks(spark, sf_dir):
    ref, cur, cols = _lineitem_sides(spark, sf_dir)
    out = drift.numeric_drift(ref, cur, cols, ks_method="asymp")  # the oracle's series
    return out.select("column", round9(F.col("statistic")).alias("statistic"),
                      "n_reference", "n_current")


def q_drift_numeric_pvalue(spark, sf_dir):
    ref, cur, cols = _lineitem_sides(spark, sf_dir)
    out = drift.numeric_drift(ref, cur, cols, ks_method="asymp")  # the oracle's series
    return out.select("column", round9(F.col("statistic")).alias("statistic"),
                      round9(F.col("p_value")).alias("p_value"), "drift_detected")


DRIFT_CONFIG = {
    "categorical_columns": ["event_type"],
    "datetime_column": "ts",
    "ks_method": "asymp",  # the oracle's series
}


def _drift_tables(spark, sf_dir):
    ref, cur = _events_sides(spark, sf_dir)
    ref = ref.select("ts", "event_type", "user_id", "props",
                     null_every_7th("event_id", "value").alias("value"))
    cur = cur.select("ts", "event_type", "user_id",
                     (null_every_7th("event_id", "value") * F.lit(1.2)).alias("value"))
    return ref, cur


def q_drift_columns(spark, sf_dir):
    ref, cur = _drift_tables(spark, sf_dir)
    return drift.rounded(drift.detect_drift(ref, cur, DRIFT_CONFIG).columns)


def q_drift_summary(spark, sf_dir):
    ref, cur = _drift_tables(spark, sf_dir)
    s = drift.detect_drift(ref, cur, DRIFT_CONFIG).summary
    return s.withColumn("drift_score", round9(F.col("drift_score")))


def _preset(spark, sf_dir):
    """events before against after, each column by the test that suits it: numbers,
    a number with few values, a category and a two-valued flag."""
    ref, cur = _drift_tables(spark, sf_dir)
    extra = {"few": F.col("user_id") % 5, "flag": F.when(F.col("event_type") == "signup", "yes").otherwise("no")}
    return drift.preset_drift(ref.drop("props").withColumns(extra), cur.withColumns(extra), DRIFT_CONFIG)


def q_drift_preset(spark, sf_dir):
    found = _preset(spark, sf_dir).columns
    return found.withColumns({c: round9(F.col(c)) for c in ("statistic", "p_value")})


def q_drift_preset_share(spark, sf_dir):
    found = _preset(spark, sf_dir).summary
    return found.withColumn("drift_score", round9(F.col("drift_score")))


def q_drift_retrain_signal(spark, sf_dir):
    ref, cur = _drift_tables(spark, sf_dir)
    return drift.drifted_columns(drift.detect_drift(ref, cur, DRIFT_CONFIG).columns)


def q_drift_column_mismatch(spark, sf_dir):
    ref, cur = _drift_tables(spark, sf_dir)
    return drift.column_mismatch(ref, cur)


# ---------------------------------------------------------------- quality

def _lineitem_with_nulls(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey",
        null_every_7th("l_orderkey", "l_quantity").alias("l_quantity"),
        null_every_7th("l_partkey", "l_extendedprice").alias("l_extendedprice"),
        null_every_7th("l_suppkey", "l_returnflag").alias("l_returnflag"),
        "l_shipdate")


def q_quality_null_counts(spark, sf_dir):
    return quality.null_counts(_lineitem_with_nulls(spark, sf_dir))


def q_quality_duplicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    t = li.select("l_returnflag", "l_linestatus", "l_quantity",
                  null_every_7th("l_orderkey", "l_tax").alias("l_tax"))
    return quality.duplicate_stats(t)


EVENTS_DTYPES = {"event_id": "int64", "value": "float64", "event_type": "object"}


def q_quality_validate(spark, sf_dir):
    return quality.validation_summary(table(spark, sf_dir, "events"), EVENTS_DTYPES)


ORDERS_DTYPES = {"o_orderkey": "int64", "o_totalprice": "float64",
                 "o_orderstatus": "int64", "o_not_there": "float64"}


def q_quality_types(spark, sf_dir):
    return quality.type_check(table(spark, sf_dir, "orders"), ORDERS_DTYPES)


# ---------------------------------------------------------------- prep

def q_prep_drop_duplicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return prep.drop_duplicates(li)


def q_prep_drop_columns(spark, sf_dir):
    return prep.drop_columns(table(spark, sf_dir, "part"), ["p_name", "p_type", "p_not_there"])


def q_prep_label_encode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", null_every_7th("o_orderkey", "o_orderpriority").alias("o_orderpriority"))
    out, _ = prep.fit_transform(o, [{"type": "encode_categorical", "columns": ["o_orderpriority"],
                                     "method": "label"}])
    return out


def _one_hot(spark, sf_dir, drop_first):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out, _ = prep.fit_transform(c, [{"type": "encode_categorical", "columns": ["c_mktsegment"],
                                     "method": "one_hot", "drop_first": drop_first}])
    return out


def q_prep_one_hot(spark, sf_dir):
    return _one_hot(spark, sf_dir, False)


def q_prep_one_hot_drop_first(spark, sf_dir):
    return _one_hot(spark, sf_dir, True)


def _lines_of_parts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", null_every_7th("l_suppkey", "l_partkey").alias("l_partkey"), "l_returnflag")


def q_prep_one_hot_vector(spark, sf_dir):
    """One-hot of a key column with nulls, as sparse vectors (shown as text)."""
    li = _lines_of_parts(spark, sf_dir).drop("l_returnflag")
    out = prep.apply_one_hot_vector(li, prep.fit_one_hot_codes(li, "l_partkey"), "part")
    return out.withColumn("part", F.col("part").cast("string"))


def q_prep_one_hot_long(spark, sf_dir):
    return prep.one_hot_long(_lines_of_parts(spark, sf_dir), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_returnflag"])


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round9(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_prep_scale(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size",
                                             F.lit(1.0).alias("p_const"))
    out, _ = prep.fit_transform(p, [{"type": "scale_numerical",
                                     "columns": ["p_retailprice", "p_size", "p_const", "p_absent"]}])
    return _rounded(out, {"p_retailprice", "p_size", "p_const"})


def _fill(spark, sf_dir, method, columns, **extra):
    t = _lineitem_with_nulls(spark, sf_dir).select("l_orderkey", "l_partkey", "l_quantity",
                                                   "l_extendedprice", "l_returnflag")
    out, _ = prep.fit_transform(t, [{"type": "fill_missing", "columns": columns,
                                     "method": method, **extra}])
    return _rounded(out, {"l_quantity", "l_extendedprice"})


def q_prep_fill_mean(spark, sf_dir):
    return _fill(spark, sf_dir, "mean", ["l_quantity", "l_extendedprice"])


def q_prep_fill_median(spark, sf_dir):
    return _fill(spark, sf_dir, "median", ["l_quantity", "l_extendedprice"])


def q_prep_fill_mode(spark, sf_dir):
    return _fill(spark, sf_dir, "mode", ["l_quantity", "l_returnflag"])


def q_prep_fill_constant(spark, sf_dir):
    return _fill(spark, sf_dir, "constant", ["l_quantity", "l_extendedprice", "l_returnflag"], value=0)


def q_prep_fit_then_transform(spark, sf_dir):
    """Fit on orders before 1998, transform the later orders with the
    training statistics (median fill, label codes, mean / std)."""
    o = table(spark, sf_dir, "orders")
    o = o.select("o_orderkey", null_every_7th("o_orderkey", "o_totalprice").alias("o_totalprice"),
                 "o_orderpriority", "o_orderdate")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    train = o.where(F.col("o_orderdate") < cut).drop("o_orderdate")
    new = o.where(F.col("o_orderdate") >= cut).drop("o_orderdate")
    steps = [{"type": "fill_missing", "columns": ["o_totalprice"], "method": "median"},
             {"type": "encode_categorical", "columns": ["o_orderpriority"], "method": "label"},
             {"type": "scale_numerical", "columns": ["o_totalprice"]}]
    _, fitted = prep.fit_transform(train, steps)
    return _rounded(prep.transform(new, fitted), {"o_totalprice"})


CHAIN_STEPS = [
    {"type": "drop_columns", "columns": ["props", "ts"]},
    {"type": "drop_duplicates"},
    {"type": "fill_missing", "columns": ["value"], "method": "mean"},
    {"type": "encode_categorical", "columns": ["event_type"], "method": "label"},
    {"type": "scale_numerical", "columns": ["value", "user_id"]},
]


def q_prep_chain(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ev = ev.select("event_id", "ts", "user_id", "event_type",
                   null_every_7th("event_id", "value").alias("value"), "props")
    out, _ = prep.fit_transform(ev, CHAIN_STEPS)
    return _rounded(out, {"value", "user_id"})


# ---------------------------------------------------------------- evaluation

QUALITY_CHARS = 1500  # documents longer than this are predicted "good"


def _doc_predictions(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select(F.col("quality").alias("label"),
                    F.when(F.col("n_chars") > QUALITY_CHARS, 1).otherwise(0).alias("prediction"))


def q_eval_confusion(spark, sf_dir):
    return metrics.confusion(_doc_predictions(spark, sf_dir))


def q_eval_classification(spark, sf_dir):
    m = metrics.classification_metrics(_doc_predictions(spark, sf_dir),
                                       metrics=["accuracy", "precision", "recall", "f1", "auc_unknown"])
    return m.withColumn("value", round9(F.col("value")))


def q_eval_regression(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500.0).alias("prediction"))
    m = metrics.regression_metrics(li, metrics=["mse", "rmse", "mae", "r2"])
    return m.withColumn("value", round9(F.col("value")))


# ---------------------------------------------------------------- performance

PERF_CONFIG = {"higher_is_better_metrics": ["mean_value", "purchase_share"],
               "lower_is_better_metrics": ["error_share", "late_share"],
               "metrics_threshold": 0.1, "overall_degradation_threshold": 0.3}


def _period_metrics(ev: DataFrame, with_signup: bool) -> DataFrame:
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    aggs = {
        "mean_value": F.avg("value"),
        "purchase_share": F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)),
        "error_share": F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)),
        "late_share": F.avg(F.when(F.col("ts") >= cut, 1.0).otherwise(0.0)),
    }
    if with_signup:
        aggs["signup_share"] = F.avg(F.when(F.col("event_type") == "signup", 1.0).otherwise(0.0))
    wide = ev.agg(*[v.alias(k) for k, v in aggs.items()])
    return wide.unpivot([], list(aggs), "metric", "value")


def _perf_inputs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    base = _period_metrics(ev.where(F.col("ts") < cut), with_signup=False)
    cur_ev = ev.where(F.col("ts") >= cut).withColumn("value", F.col("value") * 0.8) \
        .withColumn("event_type", F.when(F.col("event_type") == "error", "purchase").otherwise(F.col("event_type")))
    cur = _period_metrics(cur_ev, with_signup=True)
    return cur, base


def q_perf_changes(spark, sf_dir):
    cur, base = _perf_inputs(spark, sf_dir)
    ch = perf.metric_changes(cur, base, PERF_CONFIG)
    return ch.select("metric", *[round9(F.col(c)).alias(c) for c in
                                 ("baseline_value", "current_value", "relative_change")], "degraded")


def q_perf_summary(spark, sf_dir):
    cur, base = _perf_inputs(spark, sf_dir)
    s = perf.degradation_summary(cur, base, PERF_CONFIG)
    return s.withColumn("degradation_score", round9(F.col("degradation_score")))


def q_perf_report(spark, sf_dir):
    cur, base = _perf_inputs(spark, sf_dir)
    r = perf.performance_report(cur, base, PERF_CONFIG)
    return r.select("metric", *[round9(F.col(c)).alias(c) for c in
                                ("baseline_value", "current_value", "change_pct")], "status")


def q_perf_report_counts(spark, sf_dir):
    cur, base = _perf_inputs(spark, sf_dir)
    return perf.report_counts(perf.performance_report(cur, base, PERF_CONFIG))


def q_perf_report_long(spark, sf_dir):
    cur, base = _perf_inputs(spark, sf_dir)
    long = perf.report_long(perf.performance_report(cur, base, PERF_CONFIG))
    return long.withColumn("value", round9(F.col("value")))


# ---------------------------------------------------------------- split

def q_split_three_way(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return split.assign_split(o, ["o_orderkey"], test_size=0.2, seed=42)


# ---------------------------------------------------------------- history

def _run_metrics(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))).cast("long")
    daily = ev.groupBy(F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model"),
                       day.alias("step")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).cast("double").alias("n_events"))
    return daily.unpivot(["model", "step"], ["mean_value", "n_events"], "metric", "value")


def q_runs_latest_metric(spark, sf_dir):
    out = runs.latest_metrics(_run_metrics(spark, sf_dir))
    return out.withColumn("last_value", round9(F.col("last_value")))


def _model_versions(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    stage = (F.when(F.col("event_type") == "purchase", "Production")
             .when(F.col("event_type") == "signup", "Staging").otherwise("None"))
    day = F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))).cast("long") + 1
    return ev.groupBy(F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("name"),
                      day.alias("version"), stage.alias("stage")).agg(
        F.max("event_id").cast("string").alias("run_id"))


def q_models_latest_production(spark, sf_dir):
    return runs.latest_versions(_model_versions(spark, sf_dir), stage="Production")


def q_runs_latest_baseline(spark, sf_dir):
    """A baseline table with one stamp per day (metrics of that day's events);
    the active baseline is the latest stamp's rows."""
    ev = table(spark, sf_dir, "events")
    daily = ev.groupBy(F.to_date("ts").cast("timestamp").alias("as_of")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).cast("double").alias("n_events"),
        F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)).alias("error_share"))
    baselines = daily.unpivot(["as_of"], ["mean_value", "n_events", "error_share"], "metric", "value")
    return runs.latest_baseline(baselines).withColumn("value", round9(F.col("value")))


def q_models_latest_version(spark, sf_dir):
    return runs.latest_versions(_model_versions(spark, sf_dir))


# ---------------------------------------------------------------- training

LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_ship_days"]


def _lineitem_ml(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("l_ship_days", F.datediff(F.to_date("l_shipdate"),
                                                 F.to_date(F.lit("1995-01-01"))).cast("double"))
    # The generated columns are independent of each other, so the labels to learn
    # are made of the features: a model must then beat its trivial rival.
    li = li.withColumns({
        "band": F.when(F.col("l_quantity") <= 17, "low").when(F.col("l_quantity") <= 34, "mid").otherwise("high"),
        "large": F.when(F.col("l_quantity") > 25, "yes").otherwise("no"),
        "net": F.col("l_quantity") * 100.0 * (1.0 - F.col("l_discount"))})
    return split.assign_split(li, ["l_orderkey", "l_linenumber"], test_size=0.2, seed=42)


def _train_eval(spark, sf_dir, cfg, label, features, metric_names, source=None, floor=True):
    """Train on the train split and return, for the validation and the test
    split, facts that SQL can state exactly: rows, scored rows, whether all
    predictions and probabilities are well formed and the metrics in range, and
    (``floor``) whether the model beats its trivial rival: the majority class,
    or the mean. The tagged table is written once and feeds fit and scoring."""
    tagged = source if source is not None else _lineitem_ml(spark, sf_dir)
    path = scratch_path(spark, "tagged")
    ml.balanced(tagged.select(*features, label, "split")).write.parquet(path)
    tagged = spark.read.parquet(path)
    trained = ml.ModelTrainer(cfg).train(tagged.where(F.col("split") == "train").drop("split"), label, features)
    held = tagged.where(F.col("split") != "train")
    scored = ml.predict(trained, held, keep=["split", label])
    y, yh = F.col(label), F.col("prediction")
    total = F.aggregate("probability", F.lit(0.0), lambda acc, x: acc + x)
    whole = F.bool_and(F.col("probability").isNull() | (F.abs(total - 1.0) < 1e-6)).alias("probabilities_sum_to_one")
    if trained.task_type == "classification":
        known = F.bool_and(yh.isin(trained.classes))
        rival = held.groupBy("split", label).count().groupBy("split").agg((F.max("count") / F.sum("count")).alias("rival"))
        better = F.avg((y == yh).cast("double")).alias("own")
    else:
        known = F.bool_and(~F.isnan(yh) & (F.abs(yh) < F.lit(float("inf"))))
        rival = held.groupBy("split").agg((-F.var_pop(y)).alias("rival"))
        better = (-F.avg(F.pow(y - yh, 2))).alias("own")
    facts = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count("prediction").alias("n_scored"),
                                        known.alias("predictions_known"), whole, better)
    m = {r["metric"]: r["value"] for r in ml.evaluate(trained, held, metric_names).collect()}
    in_range = set(m) == set(metric_names) and all(v <= 1 if k in (*CLS_METRICS, "r2") else v >= 0 for k, v in m.items())
    facts = facts.join(rival, "split").withColumn("metrics_in_range", F.lit(in_range))
    cols = ["split", "n_rows", "n_scored", "predictions_known", "probabilities_sum_to_one", "metrics_in_range"]
    return facts.select(*cols, *([(F.col("own") > F.col("rival")).alias("beats_rival")] if floor else []))


CLS_METRICS = ["accuracy", "precision", "recall", "f1"]
REG_METRICS = ["mse", "rmse", "mae", "r2"]


def q_train_rf_cls(spark, sf_dir):
    cfg = {"model_type": "random_forest", "task_type": "classification",
           "model_params": {"n_estimators": 20, "max_depth": 5}}
    return _train_eval(spark, sf_dir, cfg, "band", LI_FEATURES, CLS_METRICS)


def q_train_rf_reg(spark, sf_dir):
    cfg = {"model_type": "random_forest", "task_type": "regression",
           "model_params": {"n_estimators": 20, "max_depth": 5}}
    return _train_eval(spark, sf_dir, cfg, "net", ["l_quantity", "l_discount", "l_tax"], REG_METRICS)


def q_train_gbt_cls(spark, sf_dir):
    cfg = {"model_type": "gradient_boosting", "task_type": "classification",
           "model_params": {"n_estimators": 10, "max_depth": 3}}
    return _train_eval(spark, sf_dir, cfg, "large", LI_FEATURES, CLS_METRICS)


def q_train_gbt_multi(spark, sf_dir):
    cfg = {"model_type": "gradient_boosting", "task_type": "classification",
           "model_params": {"n_estimators": 5, "max_depth": 3}}
    return _train_eval(spark, sf_dir, cfg, "band", LI_FEATURES, CLS_METRICS)


def q_train_gbt_reg(spark, sf_dir):
    cfg = {"model_type": "gradient_boosting", "task_type": "regression",
           "model_params": {"n_estimators": 10, "max_depth": 3}}
    return _train_eval(spark, sf_dir, cfg, "net", ["l_quantity", "l_discount", "l_tax"], REG_METRICS)


def q_train_logreg(spark, sf_dir):
    cfg = {"model_type": "linear", "task_type": "classification"}
    return _train_eval(spark, sf_dir, cfg, "large", LI_FEATURES, CLS_METRICS)


def q_train_linear_one_feature(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    trained = ml.ModelTrainer({"model_type": "linear", "task_type": "regression"}).train(
        li, "l_extendedprice", ["l_quantity"])
    lr = trained.model.stages[-1]
    return spark.range(1).select(F.round(F.lit(float(lr.coefficients[0])), 6).alias("slope"),
                                 F.round(F.lit(float(lr.intercept)), 6).alias("intercept"))


def _tiers(li: DataFrame) -> DataFrame:
    """A label of three values that one feature decides: trees that see every
    feature learn it to the row, so its predictions can be stated in SQL."""
    return li.withColumn("tier", F.when(F.col("l_discount") < 0.035, "low").when(F.col("l_discount") < 0.075, "mid").otherwise("high"))


FOREST = {"model_type": "random_forest", "task_type": "classification",
          "model_params": {"n_estimators": 10, "max_depth": 5, "max_features": None}}


def _confidence() -> F.Column:
    """The share of the most probable class; it must be the predicted one's."""
    return round9(F.array_max("probability")).alias("confidence")


def q_score_batch(spark, sf_dir):
    """Every lineitem row scored by a forest trained on the train split."""
    path = scratch_path(spark, "tagged")
    ml.balanced(_tiers(_lineitem_ml(spark, sf_dir)).select("l_orderkey", "l_linenumber", *LI_FEATURES, "tier", "split")).write.parquet(path)
    tagged = spark.read.parquet(path)
    trained = ml.ModelTrainer(FOREST).train(tagged.where(F.col("split") == "train").select(*LI_FEATURES, "tier"), "tier", LI_FEATURES)
    scored = ml.score_batch(trained, tagged.select("l_orderkey", "l_linenumber", *LI_FEATURES),
                            model_name="tier_rf", model_version="1", keep=["l_orderkey", "l_linenumber"])
    return scored.select("l_orderkey", "l_linenumber", "prediction", _confidence(), "batch_size", "model_name", "model_version")


def q_model_registry(spark, sf_dir):
    """Train, register, find the newest version and score: one row a customer
    segment with what the loaded model scored."""
    c = table(spark, sf_dir, "customer")
    root = scratch_path(spark, "registry")
    cfg = {"model_type": "linear", "task_type": "regression", "model_dir": root, "model_name": "balance",
           "metrics_path": f"{root}-metrics", "split_keys": ["c_custkey"]}
    features = c.select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey"), "c_acctbal")
    for _ in range(2):
        create_model_pipeline(spark, cfg).run(features, "c_acctbal")
    versions = spark.read.parquet(f"{root}/_versions")
    trained, info = ml.load_registered_model(spark, versions, "balance", root)
    scored = ml.score_batch(trained, c.select("c_mktsegment", "c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey")),
                            "balance", str(info["version"]), keep=["c_mktsegment"])
    return scored.groupBy("c_mktsegment", "model_name", "model_version", "batch_size").agg(F.count("prediction").alias("n_scored"))


# ---------------------------------------------------------------- io

def q_model_newest_saved(spark, sf_dir):
    """Two models of opposite labels are saved and no version is registered; the
    newest one on disk scores every line: one row a return flag with the rows that
    it labels as the second model was taught (one feature decides)."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", F.floor(F.col("l_quantity") / 10).cast("double").alias("tens"))
    large = F.col("tens") >= 3
    root = scratch_path(spark, "saved")
    for version, (yes, no) in (("1", ("small", "large")), ("2", ("large", "small"))):
        taught = li.select("tens", F.when(large, yes).otherwise(no).alias("size"))
        cfg = {"model_type": "random_forest", "model_params": {"n_estimators": 5, "max_depth": 2, "max_features": None}}
        ml.save_model(ml.ModelTrainer(cfg).train(taught, "size"), f"{root}/sizes/{version}")
    trained, info = ml.newest_saved_model(spark, root)
    scored = ml.score_batch(trained, li, info["name"], info["version"], keep=["l_returnflag", "tens"])
    right = F.col("prediction") == F.when(large, "large").otherwise("small")
    return scored.groupBy("l_returnflag", "model_name", "model_version").agg(F.count_if(right).alias("n_right"))


def q_train_cv(spark, sf_dir):
    """Three stratified folds over lineitem: one row a fold with its out-of-fold
    rows, those of the positive class, and whether its model beats the majority class."""
    li = _lineitem_ml(spark, sf_dir).drop("split")
    tagged = split.assign_folds(li, "large", ["l_orderkey", "l_linenumber"], k=3, seed=42)
    cfg = {"model_type": "linear", "task_type": "classification"}
    cv = ml.cross_validate(cfg, tagged, "large", ["l_quantity", "l_discount", "l_tax"], metrics=CLS_METRICS)
    yes = F.col("large") == "yes"
    rows = cv.predictions.groupBy("fold").agg(F.count("prediction").alias("n_scored"), F.count_if(yes).alias("n_yes"),
                                              F.greatest(F.avg(yes.cast("double")), F.avg((~yes).cast("double"))).alias("rival"))
    scores = cv.metrics.groupBy("fold").agg(F.count_if(F.col("value").between(0, 1)).alias("n_metrics"), F.max(F.when(F.col("metric") == "accuracy", F.col("value"))).alias("own"))
    return rows.join(scores, "fold").select("fold", "n_scored", "n_yes", "n_metrics", (F.col("own") > F.col("rival")).alias("beats_rival"))


def q_io_csv_roundtrip(spark, sf_dir):
    """orders -> CSV part files (header) -> CSV reader with NA tokens and
    type inference; integers come back as long, text as string."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        null_every_7th("o_orderkey", "o_totalprice").alias("o_price_gaps"))
    path = writers.write_table(o, scratch_path(spark, "csv-roundtrip"), fmt="csv")
    return readers.read_table(spark, {"source_type": "csv", "input_path": path})


def q_io_json_roundtrip(spark, sf_dir):
    """customer -> JSON lines -> JSON reader; columns back in source order."""
    c = table(spark, sf_dir, "customer")
    path = writers.write_table(c, scratch_path(spark, "json-roundtrip"), fmt="json")
    back = readers.read_table(spark, {"source_type": "json", "input_path": path, "lines": True})
    return back.select(*c.columns)


#: Rows of an object of columns, about, if all rows were of one nation: each is put together in one group.
JSON_ROWS = 1 << 17


def q_io_json_columns(spark, sf_dir):
    """customer as column-oriented objects, one file a nation (several for a
    table of more than JSON_ROWS rows) -> JSON reader."""
    c = table(spark, sf_dir, "customer").withColumn("c_gaps", null_every_7th("c_custkey", "c_acctbal"))
    piece = F.pmod(F.xxhash64("c_custkey"), F.lit(1 + c.count() // JSON_ROWS))
    cells = [F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("row "), F.col("c_custkey")), F.col(n)))).alias(n) for n in c.columns]
    objects = c.groupBy("c_nationkey", piece).agg(F.to_json(F.struct(*cells)).alias("value")).select("value")
    path = scratch_path(spark, "json-columns")
    objects.write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_table(spark, {"source_type": "json", "input_path": path}).select(*c.columns)


# ---------------------------------------------------------------- streaming

def q_stream_daily_drift(spark, sf_dir):
    """events arriving as a stream; each day's event_type shares against the
    first half of January (Jensen-Shannon), state kept in tables."""
    ev = table(spark, sf_dir, "events")
    stream = table_stream(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    base = scratch_path(spark, "daily-drift")
    q = monitor.start_daily_drift(stream, ref, ["event_type"], "ts", f"{base}/out",
                                  f"{base}/state", f"{base}/checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("day", "column", round9(F.col("js_divergence")).alias("js_divergence"),
                      "n_reference", "n_current", "drift_detected")


# ---------------------------------------------------------------- declared checks

def q_quality_missing_share(spark, sf_dir):
    return quality.missing_share(_lineitem_with_nulls(spark, sf_dir), threshold=0.1) \
        .withColumn("missing_share", round9(F.col("missing_share")))


def q_quality_outliers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey")
    ev = table(spark, sf_dir, "events").select("value")
    return quality.outlier_counts(o, ["o_totalprice", "o_custkey"], 3.0).unionByName(
        quality.outlier_counts(ev, ["value"], 3.0))


def q_eval_roc_auc(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id").select(F.col("quality").alias("label"), F.col("n_chars").alias("score"))
    return metrics.roc_auc(j).withColumn("auc", round9(F.col("auc")))


def q_perf_below_floor(spark, sf_dir):
    m = metrics.classification_metrics(_doc_predictions(spark, sf_dir),
                                       metrics=["accuracy", "precision", "recall", "f1"])
    return perf.below_floor(m, 0.9).withColumn("value", round9(F.col("value")))


def q_drift_wasserstein(spark, sf_dir):
    ref, cur, cols = _lineitem_sides(spark, sf_dir)
    out = drift.wasserstein_drift(ref, cur, cols)
    return out.select("column", *[round9(F.col(c)).alias(c) for c in
                                  ("wasserstein", "reference_std", "wasserstein_norm")], "drift_detected")


def q_train_feature_importance(spark, sf_dir):
    """The order of the features by importance for a target that two of them
    make, one with four times the other's weight; place 0 is no influence."""
    step = 4.0 * (F.col("l_discount") >= 0.05).cast("double") + (F.col("l_tax") >= 0.035).cast("double")
    li = _ship_days(table(spark, sf_dir, "lineitem")).select(*LI_FEATURES, step.alias("steps"))
    cfg = {"model_type": "random_forest", "task_type": "regression",
           "model_params": {"n_estimators": 10, "max_depth": 4, "max_features": None}}
    imp = ml.feature_importances(ml.ModelTrainer(cfg).train(li, "steps", LI_FEATURES))
    place = F.rank().over(Window.orderBy(F.desc("importance"))).cast("long")  # one row a feature
    return imp.select("feature", F.when(F.col("importance") > 0.01, place).otherwise(F.lit(0).cast("long")).alias("place"))


def q_train_rf_embeddings(spark, sf_dir):
    """Ten classes from a 64-float embedding (array column used as the vector)."""
    emb = table(spark, sf_dir, "embeddings")
    tagged = split.assign_split(emb, ["vec_id"], test_size=0.2, seed=42)
    cfg = {"model_type": "random_forest", "task_type": "classification",
           "model_params": {"n_estimators": 20, "max_depth": 6}}
    return _train_eval(spark, sf_dir, cfg, "label", ["embedding"], CLS_METRICS, tagged, floor=False)


def q_split_kfold(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.assign_folds(o, "o_orderpriority", ["o_orderkey"], k=5, seed=42)


def q_split_stratified(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.assign_stratified_split(o, "o_orderpriority", ["o_orderkey"], test_size=0.2, seed=42)


def q_stream_daily_numeric(spark, sf_dir):
    """events arriving as a stream: bounds of each day's KS statistic of two numeric
    columns against the first half of January, state kept as counts between cuts."""
    ev = table(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    base = scratch_path(spark, "daily-numeric-drift")
    q = monitor.start_daily_numeric_drift(table_stream(spark, sf_dir, "events"), ref, ["user_id", "value"], "ts",
                                          f"{base}/out", f"{base}/state", f"{base}/checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    rounded = [round9(F.col(c)).alias(c) for c in ("statistic", "statistic_max", "p_value")]
    return out.select("day", "column", *rounded, "n_reference", "n_current", "drift_detected", "decided")


def q_stream_daily_drift_windowed(spark, sf_dir):
    """Watermarked variant: counts in streaming state, every touched day rescored."""
    ev = table(spark, sf_dir, "events")
    stream = table_stream(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    base = scratch_path(spark, "daily-drift-windowed")
    q = monitor.start_daily_drift_windowed(stream, ref, ["event_type"], "ts", f"{base}/out",
                                           f"{base}/state", f"{base}/checkpoint", watermark="1 hour")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("day", "column", round9(F.col("js_divergence")).alias("js_divergence"),
                      "n_reference", "n_current", "drift_detected")


def _ship_days(df: DataFrame) -> DataFrame:
    return df.withColumn("l_ship_days", F.datediff(F.to_date("l_shipdate"),
                                                   F.to_date(F.lit("1995-01-01"))).cast("double"))


def q_stream_score(spark, sf_dir):
    """lineitem rows arriving as a stream, scored on arrival by a forest
    trained on the train split; the sink holds one row per arriving row."""
    tagged = _tiers(_lineitem_ml(spark, sf_dir))
    train = tagged.where(F.col("split") == "train").select(*LI_FEATURES, "tier")
    trained = ml.ModelTrainer(FOREST).train(train, "tier", LI_FEATURES)
    stream = table_stream(spark, sf_dir, "lineitem")
    base = scratch_path(spark, "stream-score")
    q = monitor.start_scoring(trained, _ship_days(stream), f"{base}/out", f"{base}/checkpoint",
                              "tier_rf", "1", keep=["l_orderkey", "l_linenumber"])
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("l_orderkey", "l_linenumber", "prediction", _confidence(), "model_name", "model_version")


# ---------------------------------------------------------------- missing values as NaN, odd names, mixed types

def _lineitem_with_nans(spark, sf_dir):
    """NaN (not NULL) where the key is a multiple of 7; a dot in a name."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("l.quantity"),
                     F.when(F.col("l_partkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"))


def q_quality_nan_counts(spark, sf_dir):
    return quality.null_counts(_lineitem_with_nans(spark, sf_dir))


def _nan_prep(spark, sf_dir, steps):
    out, _ = prep.fit_transform(_lineitem_with_nans(spark, sf_dir), steps)
    return out


def q_prep_nan_fill_scale(spark, sf_dir):
    """Mean fill and scaling of columns with NaN, one with a dotted name."""
    out = _nan_prep(spark, sf_dir, [{"type": "fill_missing", "columns": ["l.quantity"], "method": "mean"},
                                    {"type": "scale_numerical", "columns": ["l.quantity", "l_tax"]}])
    return out.select("l_orderkey", "l_linenumber", round9(F.col("`l.quantity`")).alias("l_quantity"), round9(F.col("l_tax")).alias("l_tax"))


def q_prep_nan_one_hot(spark, sf_dir):
    """One-hot of a double column (its names hold dots), then fill and scale."""
    out = _nan_prep(spark, sf_dir, [{"type": "encode_categorical", "columns": ["l_tax"], "method": "one_hot"},
                                    {"type": "fill_missing", "columns": ["l.quantity"], "method": "median"},
                                    {"type": "scale_numerical", "columns": ["l_tax_0.04"]}])
    return out.select("l_orderkey", "l_linenumber", F.col("`l.quantity`").alias("l_quantity"), F.col("`l_tax_0.0`").alias("tax_0"),
                      round9(F.col("`l_tax_0.04`")).alias("tax_4"), F.col("`l_tax_0.08`").alias("tax_8"), F.lit(len(out.columns)).cast("long").alias("n_columns"))


def q_prep_polynomial(spark, sf_dir):
    """Squares and products of two columns, then scaling of one of them."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    out, _ = prep.fit_transform(li, [{"type": "polynomial_features", "columns": ["l_quantity", "l_discount"], "degree": 2},
                                     {"type": "scale_numerical", "columns": ["l_quantity*l_discount"]}])
    return out.select("l_orderkey", "l_linenumber", *[round9(F.col(f"`{a}`")).alias(b) for a, b in
                      (("l_quantity*l_quantity", "qq"), ("l_quantity*l_discount", "qd"), ("l_discount*l_discount", "dd"))])


def q_drift_nan_ks(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit(SHIP_CUT).cast("timestamp_ntz")
    cols = [F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("l.quantity")]
    out = drift.numeric_drift(li.where(F.col("l_shipdate") < cut).select(*cols), li.where(F.col("l_shipdate") >= cut).select(*cols),
                              ["l.quantity"], ks_method="asymp")
    return out.select("column", round9(F.col("statistic")).alias("statistic"), "n_reference", "n_current")


def q_eval_mixed_types(spark, sf_dir):
    """A long label against a double prediction."""
    t = _doc_predictions(spark, sf_dir).select(F.col("label").cast("long").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    return metrics.classification_metrics(t, metrics=CLS_METRICS).withColumn("value", round9(F.col("value")))


def q_io_csv_text_roundtrip(spark, sf_dir):
    """Texts with quotes, line breaks and edge blanks, and codes like 1D."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(' "'), F.col("text"), F.lit('", said ')).alias("quoted"),
        F.concat((F.col("doc_id") % 10).cast("string"), F.lit("D")).alias("code"))
    path = writers.write_table(d, scratch_path(spark, "csv-text"), fmt="csv")
    back = readers.read_table(spark, {"source_type": "csv", "input_path": path})
    return back.select("doc_id", F.md5("quoted").alias("quoted_md5"), "code")


def q_runs_latest_without_steps(spark, sf_dir):
    """Metric values logged without a step: the latest stamp's value."""
    ev = table(spark, sf_dir, "events")
    logged = ev.select(F.col("event_type").alias("model"), F.lit("value").alias("metric"), F.lit(None).cast("long").alias("step"),
                       "value", F.col("ts").cast("timestamp").alias("ts"))
    return runs.latest_metrics(logged).withColumn("last_value", round9(F.col("last_value")))


def q_drift_chi_square(spark, sf_dir):
    ref, cur = _events_sides(spark, sf_dir)
    out = drift.chi_square_drift(ref, cur, ["event_type"])
    return out.select("column", round9(F.col("statistic")).alias("statistic"), "degrees_of_freedom", round9(F.col("p_value")).alias("p_value"), "drift_detected")


def q_drift_proportions(spark, sf_dir):
    """Two-valued columns: shares of the two sides by the z-test."""
    ref, cur = _events_sides(spark, sf_dir)
    flags = [F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("parity"),
             F.when(F.col("event_type") == "signup", "signup").otherwise("other").alias("signup")]
    out = drift.proportion_drift(ref.select(*flags), cur.select(*flags), ["parity", "signup"])
    return out.select("column", round9(F.col("statistic")).alias("statistic"), round9(F.col("p_value")).alias("p_value"), "drift_detected")


# ---------------------------------------------------------------- whole jobs and their sinks

def q_job_data(spark, sf_dir):
    """The data job over a CSV copy of orders: validation gate passed, steps
    fitted and applied, the processed table read back from its CSV sink."""
    base = scratch_path(spark, "job-data")
    o = table(spark, sf_dir, "orders").select("o_orderkey", null_every_7th("o_orderkey", "o_orderpriority").alias("o_orderpriority"))
    writers.write_table(o, f"{base}/in.csv", fmt="csv")
    cfg = {"ingestion": {"source_type": "csv", "source_path": f"{base}/in.csv"}, "output_path": f"{base}/out.csv",
           "validation_schema": {"dtypes": {"o_orderkey": "int64"}}, "metadata_path": f"{base}/runs",
           "preprocessing": {"preprocessing_steps": [{"type": "encode_categorical", "columns": ["o_orderpriority"], "method": "label"}]}}
    create_data_pipeline(spark, cfg).run()
    return readers.read_by_extension(spark, f"{base}/out.csv")


def q_job_data_gate(spark, sf_dir):
    """What the gate says of a table with duplicate rows, and that a forced run
    records: (refused, recorded_valid, raw_rows, raw_columns, duplicates)."""
    base = scratch_path(spark, "job-gate")
    table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").write.parquet(f"{base}/in.parquet")
    cfg = {"ingestion": {"source_type": "parquet"}, "input_path": f"{base}/in.parquet", "metadata_path": f"{base}/runs"}
    try:
        create_data_pipeline(spark, cfg).run()
        refused = False
    except ValueError:
        refused = True
    create_data_pipeline(spark, {**cfg, "force_continue": True}).run()
    m = F.col("metadata")
    return spark.read.parquet(f"{base}/runs").select(
        F.lit(refused).alias("refused"), F.get_json_object(m, "$.is_valid").cast("boolean").alias("recorded_valid"),
        F.get_json_object(m, "$.raw_shape[0]").cast("long").alias("raw_rows"), F.get_json_object(m, "$.raw_shape[1]").cast("long").alias("raw_columns"),
        F.get_json_object(m, "$.validation_results.duplicate_rows").cast("long").alias("duplicates"))


def q_job_monitoring(spark, sf_dir):
    """The monitoring job over two files; its stored, stamped drift table."""
    base = scratch_path(spark, "job-monitoring")
    ref, cur = _drift_tables(spark, sf_dir)
    ref.write.parquet(f"{base}/reference.parquet")
    cur.write.parquet(f"{base}/current.parquet")
    run_monitoring(spark, {**DRIFT_CONFIG, "reference_data_path": f"{base}/reference.parquet",
                           "current_data_path": f"{base}/current.parquet", "output_path": f"{base}/out"})
    stored = spark.read.parquet(f"{base}/out/drift_columns").where(F.col("computed_at").isNotNull())
    return drift.rounded(stored.drop("computed_at"))


def q_sink_metrics(spark, sf_dir):
    """Metrics written as baselines under two stamps and as a JSON object: the
    active baseline, and the object read back."""
    base = scratch_path(spark, "sink-metrics")
    cur, old = _perf_inputs(spark, sf_dir)
    writers.save_metrics_as_baseline(old, f"{base}/baselines", as_of="2024-01-14 00:00:00")
    writers.save_metrics_as_baseline(cur, f"{base}/baselines", as_of="2024-01-31 00:00:00")
    active = runs.latest_baseline(spark.read.parquet(f"{base}/baselines"))
    old.groupBy().pivot("metric").agg(F.first("value")).coalesce(1).write.json(f"{base}/object")
    parts = active.withColumn("source", F.lit("active")).unionByName(
        readers.read_metrics(spark, f"{base}/object").withColumn("source", F.lit("object")))
    return parts.select("source", "metric", round9(F.col("value")).alias("value"))


def q_job_all(spark, sf_dir):
    """Data job, then model job on its output, whose label is named wrongly and
    falls back to the last column: logged metrics and parameters of the run."""
    base = scratch_path(spark, "job-all")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 0, "plus").otherwise("minus").alias("side"))
    c.write.parquet(f"{base}/in.parquet")
    out = run_all(spark, {"ingestion": {"source_type": "parquet", "input_path": f"{base}/in.parquet"}},
                  {"trainer": {"model_type": "linear", "task_type": "classification", "model_params": {"max_iter": 20}},
                   "evaluator": {"metrics": ["accuracy", "f1"]}, "model_name": "sides", "model_dir": f"{base}/models",
                   "metrics_path": f"{base}/metrics", "params_path": f"{base}/params"}, "no_such_column")
    logged = runs.latest_metrics(spark.read.parquet(f"{base}/metrics"))
    rows = F.lit(int(out["processed_shape"][0])).cast("long")
    return logged.select("model", "metric", F.col("last_value").between(0, 1).alias("in_range"), rows.alias("processed_rows"),
                         F.lit(int(spark.read.parquet(f"{base}/params").where("param = 'max_iter' AND value = '20'").count())).cast("long").alias("params_logged"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "job_data": q_job_data,
    "job_data_gate": q_job_data_gate,
    "job_monitoring": q_job_monitoring,
    "job_all": q_job_all,
    "sink_metrics": q_sink_metrics,
    "quality_nan_counts": q_quality_nan_counts,
    "prep_nan_fill_scale": q_prep_nan_fill_scale,
    "prep_nan_one_hot": q_prep_nan_one_hot,
    "prep_polynomial": q_prep_polynomial,
    "drift_nan_ks": q_drift_nan_ks,
    "drift_chi_square": q_drift_chi_square,
    "drift_proportions": q_drift_proportions,
    "eval_mixed_types": q_eval_mixed_types,
    "io_csv_text_roundtrip": q_io_csv_text_roundtrip,
    "runs_latest_without_steps": q_runs_latest_without_steps,
    "model_registry": q_model_registry,
    "model_newest_saved": q_model_newest_saved,
    "quality_duplicates": q_quality_duplicates,
    "quality_missing_share": q_quality_missing_share,
    "quality_null_counts": q_quality_null_counts,
    "quality_outliers": q_quality_outliers,
    "quality_types": q_quality_types,
    "quality_validate": q_quality_validate,
    "prep_chain": q_prep_chain,
    "prep_drop_columns": q_prep_drop_columns,
    "prep_drop_duplicates": q_prep_drop_duplicates,
    "prep_fill_constant": q_prep_fill_constant,
    "prep_fill_mean": q_prep_fill_mean,
    "prep_fill_median": q_prep_fill_median,
    "prep_fill_mode": q_prep_fill_mode,
    "prep_fit_then_transform": q_prep_fit_then_transform,
    "prep_label_encode": q_prep_label_encode,
    "prep_one_hot": q_prep_one_hot,
    "prep_one_hot_vector": q_prep_one_hot_vector,
    "prep_one_hot_long": q_prep_one_hot_long,
    "prep_one_hot_drop_first": q_prep_one_hot_drop_first,
    "prep_scale": q_prep_scale,
    "drift_categorical": q_drift_categorical,
    "drift_column_mismatch": q_drift_column_mismatch,
    "drift_columns": q_drift_columns,
    "drift_numeric_ks": q_drift_numeric_ks,
    "drift_numeric_pvalue": q_drift_numeric_pvalue,
    "drift_preset": q_drift_preset,
    "drift_preset_share": q_drift_preset_share,
    "drift_retrain_signal": q_drift_retrain_signal,
    "drift_summary": q_drift_summary,
    "drift_wasserstein": q_drift_wasserstein,
    "eval_classification": q_eval_classification,
    "eval_confusion": q_eval_confusion,
    "eval_regression": q_eval_regression,
    "eval_roc_auc": q_eval_roc_auc,
    "perf_below_floor": q_perf_below_floor,
    "perf_changes": q_perf_changes,
    "perf_report": q_perf_report,
    "perf_report_counts": q_perf_report_counts,
    "perf_report_long": q_perf_report_long,
    "perf_summary": q_perf_summary,
    "split_kfold": q_split_kfold,
    "split_stratified": q_split_stratified,
    "split_three_way": q_split_three_way,
    "runs_latest_metric": q_runs_latest_metric,
    "models_latest_version": q_models_latest_version,
    "models_latest_production": q_models_latest_production,
    "runs_latest_baseline": q_runs_latest_baseline,
    "train_feature_importance": q_train_feature_importance,
    "train_gbt_cls": q_train_gbt_cls,
    "train_gbt_multi": q_train_gbt_multi,
    "train_gbt_reg": q_train_gbt_reg,
    "train_linear_one_feature": q_train_linear_one_feature,
    "train_logreg": q_train_logreg,
    "train_cv": q_train_cv,
    "train_rf_cls": q_train_rf_cls,
    "train_rf_embeddings": q_train_rf_embeddings,
    "train_rf_reg": q_train_rf_reg,
    "score_batch": q_score_batch,
    "io_csv_roundtrip": q_io_csv_roundtrip,
    "io_json_roundtrip": q_io_json_roundtrip,
    "io_json_columns": q_io_json_columns,
    "stream_daily_drift": q_stream_daily_drift,
    "stream_daily_drift_windowed": q_stream_daily_drift_windowed,
    "stream_daily_numeric": q_stream_daily_numeric,
    "stream_score": q_stream_score,
}
