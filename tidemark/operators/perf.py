"""Model performance against a baseline: relative change per metric,
degradation verdicts and the comparison report. Inputs are (metric, value)
tables; the baseline side is broadcast (one row per metric name)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import pct_change, relative_change

# Defaults of the monitored configuration.
DEFAULT_METRICS_THRESHOLD = 0.1
DEFAULT_OVERALL_DEGRADATION_THRESHOLD = 0.3


@dataclass
class PerfConfig:
    metrics_threshold: float = DEFAULT_METRICS_THRESHOLD
    overall_degradation_threshold: float = DEFAULT_OVERALL_DEGRADATION_THRESHOLD
    higher_is_better_metrics: tuple = ()
    lower_is_better_metrics: tuple = ()

    @classmethod
    def from_dict(cls, cfg: dict | None) -> "PerfConfig":
        cfg = dict(cfg or {})
        return cls(cfg.get("metrics_threshold", DEFAULT_METRICS_THRESHOLD),
                   cfg.get("overall_degradation_threshold", DEFAULT_OVERALL_DEGRADATION_THRESHOLD),
                   tuple(cfg.get("higher_is_better_metrics", []) or []),
                   tuple(cfg.get("lower_is_better_metrics", []) or []))


def _lower_is_better(cfg: PerfConfig) -> F.Column:
    """A metric in neither list counts as higher-is-better."""
    if not cfg.lower_is_better_metrics:
        return F.lit(False)
    lower = F.col("metric").isin(list(cfg.lower_is_better_metrics))
    if cfg.higher_is_better_metrics:
        lower = lower & ~F.col("metric").isin(list(cfg.higher_is_better_metrics))
    return lower


def _joined(current: DataFrame, baseline: DataFrame) -> DataFrame:
    base = baseline.select(F.col("metric"), F.col("value").cast("double").alias("baseline_value"))
    cur = current.select(F.col("metric"), F.col("value").cast("double").alias("current_value"))
    return cur.join(base, "metric", "left")


def metric_changes(current: DataFrame, baseline: DataFrame, config: dict | PerfConfig | None = None) -> DataFrame:
    """(metric, baseline_value, current_value, relative_change, degraded) for
    current metrics found in the baseline."""
    cfg = config if isinstance(config, PerfConfig) else PerfConfig.from_dict(config)
    j = _joined(current, baseline).where(F.col("baseline_value").isNotNull())
    j = j.withColumn("relative_change", relative_change(F.col("current_value"), F.col("baseline_value")))
    j = j.withColumn("_lower", _lower_is_better(cfg))
    ch, lower, t = F.col("relative_change"), F.col("_lower"), F.lit(cfg.metrics_threshold)
    degraded = F.when(lower, ch > t).otherwise(ch < -t)
    return j.select("metric", "baseline_value", "current_value", "relative_change",
                    degraded.alias("degraded"))


def degradation_summary(current: DataFrame, baseline: DataFrame,
                        config: dict | PerfConfig | None = None) -> DataFrame:
    """One row (degraded_metrics, total_metrics, degradation_score,
    performance_degradation_detected). total_metrics counts every current
    metric, matched or not; with no metrics the score is NULL."""
    cfg = config if isinstance(config, PerfConfig) else PerfConfig.from_dict(config)
    changes = metric_changes(current, baseline, cfg)
    deg = changes.agg(F.count_if(F.col("degraded")).cast("long").alias("degraded_metrics"))
    tot = current.agg(F.count(F.lit(1)).cast("long").alias("total_metrics"))
    score = F.try_divide(F.col("degraded_metrics").cast("double"), F.col("total_metrics"))
    return deg.crossJoin(tot).select(  # two one-row tables
        "degraded_metrics", "total_metrics", score.alias("degradation_score"),
        F.coalesce(score >= F.lit(cfg.overall_degradation_threshold), F.lit(False))
        .alias("performance_degradation_detected"))


def performance_report(current: DataFrame, baseline: DataFrame,
                       config: dict | PerfConfig | None = None) -> DataFrame:
    """(metric, baseline_value, current_value, change_pct, status) ordered by
    |change_pct| descending; status is degraded / improved / unchanged, with
    the threshold in percent."""
    cfg = config if isinstance(config, PerfConfig) else PerfConfig.from_dict(config)
    j = _joined(current, baseline).where(F.col("baseline_value").isNotNull())
    pct = pct_change(F.col("current_value"), F.col("baseline_value"))
    t = F.lit(cfg.metrics_threshold * 100.0)
    out = j.select("metric", "baseline_value", "current_value", pct.alias("change_pct"),
                   _lower_is_better(cfg).alias("_lower"))
    pc, lower = F.col("change_pct"), F.col("_lower")
    worse = F.when(lower, pc > t).otherwise(pc < -t)
    better = F.when(lower, pc < -t).otherwise(pc > t)
    status = F.when(worse, "degraded").when(better, "improved").otherwise("unchanged")
    return (out.withColumn("status", status).drop("_lower")
            .orderBy(F.abs("change_pct").desc(), "metric"))


def report_counts(report: DataFrame) -> DataFrame:
    """(status, n)."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def report_long(report: DataFrame) -> DataFrame:
    """(metric, variable, value) with variable Baseline / Current."""
    return report.select("metric", F.col("baseline_value").alias("Baseline"),
                         F.col("current_value").alias("Current")).unpivot(
        ["metric"], ["Baseline", "Current"], "variable", "value")


class ModelPerformanceMonitor:
    """Baseline holder: ``detect_performance_degradation(current_metrics)``."""

    def __init__(self, spark, config: dict | None = None):
        self.spark = spark
        self.config = dict(config or {})
        self.baseline: DataFrame | None = None
        if self.config.get("baseline_metrics_path"):
            self.load_baseline_metrics(self.config["baseline_metrics_path"])

    def load_baseline_metrics(self, path: str) -> DataFrame:
        from tidemark.sources.readers import read_metrics
        self.baseline = read_metrics(self.spark, path)
        return self.baseline

    def set_baseline(self, metrics: DataFrame) -> None:
        self.baseline = metrics

    def detect_performance_degradation(self, current: DataFrame):
        if self.baseline is None:
            raise ValueError("load or set baseline metrics first")
        return (metric_changes(current, self.baseline, self.config),
                degradation_summary(current, self.baseline, self.config))


def below_floor(metrics: DataFrame, floor: float, metric_names: list[str] | None = None) -> DataFrame:
    """(metric, value, floor): current metrics under an absolute floor
    (optionally only the named ones)."""
    m = metrics
    if metric_names:
        m = m.where(F.col("metric").isin(list(metric_names)))
    return m.where(F.col("value") < F.lit(floor)).select("metric", "value", F.lit(float(floor)).alias("floor"))
