"""Data drift between a reference and a current table.

Every column is handled in one job: both tables are unpivoted to long form
(column, value) with a side flag, aggregated once per distinct value (partial
aggregation collapses hot values map-side), then

* categorical columns: shares per side -> Jensen-Shannon divergence;
* numeric columns: two-sample Kolmogorov-Smirnov statistic over the running
  counts (``ordered.ks_statistics``) and its asymptotic p-value.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import (chi_square_pvalue, js_term, ks_pvalue, normal_two_sided, qcol,
                                      round9, safe_div)
from tidemark.operators.ordered import ks_statistics, wasserstein_distances
from tidemark.session import scratch_path

# Defaults of the monitored configuration.
DEFAULT_DRIFT_THRESHOLD = 0.05          # KS p-value below this -> drift
DEFAULT_JS_THRESHOLD = 0.1              # JS divergence above this -> drift
DEFAULT_OVERALL_DRIFT_THRESHOLD = 0.3   # share of drifted columns, inclusive
INSUFFICIENT_DATA = "Insufficient data after dropping NaN values"

DRIFT_COLUMNS_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("statistic", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("js_divergence", T.DoubleType()),
    T.StructField("n_reference", T.LongType()),
    T.StructField("n_current", T.LongType()),
    T.StructField("drift_detected", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


@dataclass
class DriftConfig:
    drift_threshold: float = DEFAULT_DRIFT_THRESHOLD
    js_divergence_threshold: float = DEFAULT_JS_THRESHOLD
    overall_drift_threshold: float = DEFAULT_OVERALL_DRIFT_THRESHOLD
    categorical_columns: list[str] = field(default_factory=list)
    numerical_columns: list[str] = field(default_factory=list)
    datetime_column: str | None = None
    ks_method: str = "auto"

    @classmethod
    def from_dict(cls, cfg: dict | None) -> "DriftConfig":
        cfg = dict(cfg or {})
        return cls(
            drift_threshold=cfg.get("drift_threshold", DEFAULT_DRIFT_THRESHOLD),
            js_divergence_threshold=cfg.get("js_divergence_threshold", DEFAULT_JS_THRESHOLD),
            overall_drift_threshold=cfg.get("overall_drift_threshold", DEFAULT_OVERALL_DRIFT_THRESHOLD),
            categorical_columns=list(cfg.get("categorical_columns", []) or []),
            numerical_columns=list(cfg.get("numerical_columns", []) or []),
            datetime_column=cfg.get("datetime_column"),
            ks_method=cfg.get("ks_method", "auto"),
        )


# ---------------------------------------------------------------- columns

def column_mismatch(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(column, side, n_values): columns present in only one table; side is
    'missing_in_current' or 'extra_in_current'; n_values counts the column's
    non-null values on the side that has it (one aggregate per side)."""
    ref, cur = set(reference.columns), set(current.columns)
    parts = []
    for df, names, side in ((reference, sorted(ref - cur), "missing_in_current"),
                            (current, sorted(cur - ref), "extra_in_current")):
        if not names:
            continue
        counts = df.agg(*[F.count(_present(df, c)).alias(c) for c in names])
        parts.append(counts.unpivot([], [qcol(c) for c in names], "column", "n_values")
                     .select("column", F.lit(side).alias("side"), F.col("n_values").cast("long")))
    if not parts:
        return reference.sparkSession.createDataFrame([], "column string, side string, n_values long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def common_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns in both tables, sorted by name."""
    cur = set(current.columns)
    return sorted(c for c in set(reference.columns) if c in cur)


def route_columns(reference: DataFrame, columns: list[str], cfg: DriftConfig):
    """Split columns into (categorical, numeric, unsupported); the datetime
    column is skipped. Listed categorical or string -> categorical."""
    types = dict((f.name, f.dataType) for f in reference.schema.fields)
    cat, num, bad = [], [], []
    for c in columns:
        if c == cfg.datetime_column:
            continue
        t = types[c]
        if c in cfg.categorical_columns or isinstance(t, T.StringType):
            cat.append(c)
        elif isinstance(t, _NUMERIC):
            num.append(c)
        else:
            bad.append((c, t.simpleString()))
    return cat, num, bad


def _present(df: DataFrame, c: str):
    """The column with NaN as NULL: both are missing values."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(qcol(c)), qcol(c))
    return qcol(c)


def _long(df: DataFrame, columns: list[str], value_type: str, is_ref: int) -> DataFrame:
    """Unpivot ``columns`` to (column, value, is_ref), dropping NULL values."""
    cast = df.select(*[_present(df, c).cast(value_type).alias(c) for c in columns])
    long = cast.unpivot([], [qcol(c) for c in columns], "column", "value")
    return long.where(F.col("value").isNotNull()).withColumn("is_ref", F.lit(is_ref))


def side_counts(reference: DataFrame, current: DataFrame, columns: list[str],
                value_type: str, profile: DataFrame | None = None) -> DataFrame:
    """(column, value, n_ref, n_cur) per distinct non-null value, the union of
    both sides' keys with 0 for an absent side. One shuffle. With a stored
    reference ``profile`` (column, value, n_ref) only the current side is
    scanned."""
    if profile is not None:
        ref = (profile.where(F.col("column").isin(columns))
               .select("column", F.col("value").cast(value_type).alias("value"),
                       F.col("n_ref").cast("long").alias("n_ref"), F.lit(0).cast("long").alias("n_cur")))
        cur = _long(current, columns, value_type, 0).select(
            "column", "value", F.lit(0).cast("long").alias("n_ref"), F.lit(1).cast("long").alias("n_cur"))
        return ref.unionByName(cur).groupBy("column", "value").agg(
            F.sum("n_ref").cast("long").alias("n_ref"), F.sum("n_cur").cast("long").alias("n_cur"))
    both = _long(reference, columns, value_type, 1).unionByName(_long(current, columns, value_type, 0))
    return both.groupBy("column", "value").agg(
        F.sum("is_ref").cast("long").alias("n_ref"),
        F.sum(1 - F.col("is_ref")).cast("long").alias("n_cur"))


def side_totals(reference: DataFrame, current: DataFrame, columns: list[str],
                profile: DataFrame | None = None) -> DataFrame:
    """(column, tot_ref, tot_cur): non-null counts per column and side, from
    two global aggregates (map-side partial counts, one row each), or from the
    stored reference profile. The result has one row per column, so it is
    broadcast wherever it is joined."""
    def side(df, name):
        wide = df.agg(*[F.count(_present(df, c)).cast("long").alias(c) for c in columns])
        return wide.unpivot([], [qcol(c) for c in columns], "column", name)
    if profile is not None:
        names = reference.sparkSession.createDataFrame([(c,) for c in columns], "column string")
        ref = names.join(profile.where(F.col("column").isin(columns)).groupBy("column")
                         .agg(F.sum("n_ref").cast("long").alias("tot_ref")), "column", "left") \
            .select("column", F.coalesce(F.col("tot_ref"), F.lit(0)).cast("long").alias("tot_ref"))
        return ref.join(side(current, "tot_cur"), "column")
    return side(reference, "tot_ref").join(side(current, "tot_cur"), "column")


def _names(spark, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in columns], "column string")


# ---------------------------------------------------------------- categorical

def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                      js_threshold: float = DEFAULT_JS_THRESHOLD, totals: DataFrame | None = None,
                      profile: DataFrame | None = None) -> DataFrame:
    """One row per column: Jensen-Shannon divergence of the value shares.

    One plan: per-value counts (one shuffle, consumed once) joined with the
    broadcast per-column totals, then summed per column."""
    spark = reference.sparkSession
    if not columns:
        return spark.createDataFrame([], DRIFT_COLUMNS_SCHEMA)
    totals = F.broadcast(totals if totals is not None else side_totals(reference, current, columns, profile))
    counts = side_counts(reference, current, columns, "string", profile)
    js = counts.join(totals, "column").groupBy("column").agg(
        F.sum(js_term(safe_div(F.col("n_ref"), F.col("tot_ref")),
                      safe_div(F.col("n_cur"), F.col("tot_cur")))).alias("js"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"))
    out = _names(spark, columns).join(F.broadcast(js), "column", "left")
    jsv = F.coalesce(F.col("js"), F.lit(0.0))
    return out.select(
        "column",
        F.lit("categorical").alias("kind"),
        F.lit("js_divergence").alias("method"),
        F.lit(None).cast("double").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
        jsv.alias("js_divergence"),
        F.coalesce(F.col("tot_ref"), F.lit(0)).cast("long").alias("n_reference"),
        F.coalesce(F.col("tot_cur"), F.lit(0)).cast("long").alias("n_current"),
        (jsv > F.lit(js_threshold)).alias("drift_detected"),
        F.lit(None).cast("string").alias("error"),
    )


# ---------------------------------------------------------------- numeric

def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                  p_threshold: float = DEFAULT_DRIFT_THRESHOLD, totals: DataFrame | None = None,
                  ks_method: str = "auto", profile: DataFrame | None = None) -> DataFrame:
    """One row per column: KS statistic, p-value, drift iff p < threshold.
    A side with no non-null value gives no statistic and an error message.
    ``ks_method``: "auto" (the default: exact lattice-path p-value when both
    sides hold at most 10,000 values, computed per column on the
    one-row-per-column result) or "asymp" (always the limiting distribution).
    Totals come from broadcast global aggregates; the per-value counts (one
    shuffle) feed the sorted scan once."""
    spark = reference.sparkSession
    if not columns:
        return spark.createDataFrame([], DRIFT_COLUMNS_SCHEMA)
    totals = F.broadcast(totals if totals is not None else side_totals(reference, current, columns, profile))
    counts = side_counts(reference, current, columns, "double", profile)
    ks = ks_statistics(counts, totals)
    out = _names(spark, columns).join(F.broadcast(ks), "column", "left")
    if ks_method == "auto":
        # The exact p-value reads the statistics a second time: take the
        # (one row per column) result once instead of running the scan twice.
        out = spark.createDataFrame(
            [tuple(r) for r in out.select("column", "statistic", "tot_ref", "tot_cur").collect()],
            "column string, statistic double, tot_ref long, tot_cur long")
    n_ref = F.coalesce(F.col("tot_ref"), F.lit(0)).cast("long")
    n_cur = F.coalesce(F.col("tot_cur"), F.lit(0)).cast("long")
    empty = (n_ref == 0) | (n_cur == 0)
    stat = F.when(empty, F.lit(None).cast("double")).otherwise(F.col("statistic"))
    p = ks_pvalue(stat, n_ref, n_cur)
    if ks_method == "auto":
        from tidemark.functions.ks_exact import exact_pvalues
        small = out.select("column", stat.alias("statistic"), n_ref.alias("n_reference"),
                           n_cur.alias("n_current"))
        exact = small.groupBy("column").applyInPandas(exact_pvalues, "column string, p_exact double")
        out = out.join(F.broadcast(exact), "column", "left")  # one row per column
        p = F.coalesce(F.col("p_exact"), p)
    elif ks_method != "asymp":
        raise ValueError(f"ks_method {ks_method!r} is neither auto nor asymp")
    return out.select(
        "column",
        F.lit("numeric").alias("kind"),
        F.lit("ks_test").alias("method"),
        stat.alias("statistic"),
        p.alias("p_value"),
        F.lit(None).cast("double").alias("js_divergence"),
        n_ref.alias("n_reference"),
        n_cur.alias("n_current"),
        F.when(empty, F.lit(False)).otherwise(p < F.lit(p_threshold)).alias("drift_detected"),
        F.when(empty, F.lit(INSUFFICIENT_DATA)).otherwise(F.lit(None).cast("string")).alias("error"),
    )


DEFAULT_WASSERSTEIN_THRESHOLD = 0.1  # normalised distance above this -> drift


def wasserstein_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                      threshold: float = DEFAULT_WASSERSTEIN_THRESHOLD) -> DataFrame:
    """(column, wasserstein, reference_std, wasserstein_norm, drift_detected):
    first Wasserstein distance, normalised by the reference's population
    standard deviation (a zero deviation leaves it NULL)."""
    spark = reference.sparkSession
    totals = F.broadcast(side_totals(reference, current, columns))
    counts = side_counts(reference, current, columns, "double")
    w = wasserstein_distances(counts, totals)
    std = reference.agg(*[F.stddev_pop(_present(reference, c).cast("double")).alias(c) for c in columns]) \
        .unpivot([], [qcol(c) for c in columns], "column", "reference_std")
    out = _names(spark, columns).join(F.broadcast(w), "column", "left").join(F.broadcast(std), "column", "left")
    norm = F.try_divide(F.col("wasserstein"), F.col("reference_std"))
    return out.select("column", "wasserstein", "reference_std", norm.alias("wasserstein_norm"),
                      F.coalesce(norm > F.lit(threshold), F.lit(False)).alias("drift_detected"))


def _independence(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Per (column, value): the four numbers a test of equal shares needs."""
    totals = F.broadcast(side_totals(reference, current, columns))
    return side_counts(reference, current, columns, "string").join(totals, "column")


def chi_square_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                     threshold: float = DEFAULT_DRIFT_THRESHOLD) -> DataFrame:
    """(column, statistic, degrees_of_freedom, p_value, drift_detected): Pearson's
    chi-square of the current value counts against the reference's shares scaled
    to the current size, over the reference's values; degrees of freedom are
    those values less one. A current value that the reference lacks has no
    expected count: the statistic is then infinite and the p-value 0. A column
    with one value, or an empty side, has no p-value and no drift."""
    out = _chi_square(_independence(reference, current, columns))
    out = _names(reference.sparkSession, columns).join(F.broadcast(out), "column", "left")
    return out.withColumn("drift_detected", F.coalesce(F.col("p_value") < F.lit(threshold), F.lit(False)))


def _chi_square(counts: DataFrame) -> DataFrame:
    expected = F.col("n_ref").cast("double") * F.col("tot_cur") / F.col("tot_ref")
    term = F.when(F.col("n_ref") > 0, F.pow(F.col("n_cur") - expected, 2) / expected).otherwise(F.lit(float("inf")))
    out = counts.where((F.col("tot_ref") > 0) & (F.col("tot_cur") > 0)).groupBy("column").agg(
        F.sum(term).alias("statistic"), (F.count_if(F.col("n_ref") > 0) - 1).alias("degrees_of_freedom"))
    p = F.when(F.col("degrees_of_freedom") > 0, chi_square_pvalue(F.col("statistic"), F.col("degrees_of_freedom")))
    return out.withColumn("p_value", p)


def proportion_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                     threshold: float = DEFAULT_DRIFT_THRESHOLD) -> DataFrame:
    """(column, statistic, p_value, drift_detected) of columns with at most two
    values: the two-sided z-test of the share of the column's least value, with
    the pooled share's variance. A column with one value on both sides has
    statistic 0 and p-value 1; more than two values, or an empty side, give
    neither and no drift."""
    out = _proportions(_independence(reference, current, columns))
    out = _names(reference.sparkSession, columns).join(F.broadcast(out), "column", "left")
    return out.withColumn("drift_detected", F.coalesce(F.col("p_value") < F.lit(threshold), F.lit(False)))


def _proportions(counts: DataFrame) -> DataFrame:
    counts = counts.where((F.col("tot_ref") > 0) & (F.col("tot_cur") > 0))
    first = counts.groupBy("column").agg(
        F.min(F.struct("value", "n_ref", "n_cur", "tot_ref", "tot_cur")).alias("f"), F.count(F.lit(1)).alias("n_values"))
    n, m = F.col("f.tot_ref").cast("double"), F.col("f.tot_cur").cast("double")
    pooled = (F.col("f.n_ref") + F.col("f.n_cur")) / (n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    z = F.when(F.col("n_values") <= 2, F.coalesce(F.try_divide(F.col("f.n_ref") / n - F.col("f.n_cur") / m, spread), F.lit(0.0)))
    return first.select("column", z.alias("statistic")).withColumn("p_value", F.when(F.col("statistic").isNotNull(), normal_two_sided(F.col("statistic"))))


# ---------------------------------------------------------------- a test for each column

# The limits of the monitored preset.
PRESET_SMALL = 1000           # reference values up to which tests are used, distances above
PRESET_FEW = 5                # a number with at most so many values is a category
PRESET_DISTANCE = 0.1         # a distance of this or more -> drift
PRESET_OVERALL = 0.5          # share of drifted columns, inclusive


@dataclass
class PresetResult:
    columns: DataFrame          # (column, method, statistic, p_value, n_reference, n_current, n_values, drift_detected)
    summary: DataFrame          # one row


def preset_drift(reference: DataFrame, current: DataFrame, config: dict | DriftConfig | None = None) -> PresetResult:
    """Each common column by the test that suits it, and the share that drifted.

    Up to 1000 reference values: numbers by Kolmogorov-Smirnov, categories and
    numbers of at most five values by chi-square, or by the z-test of a share when
    there are at most two values; a p-value under the threshold is drift. Above:
    the Wasserstein distance in reference deviations, and the square root of the
    base-2 Jensen-Shannon divergence; 0.1 or more is drift. Values of both sides
    count. A column with an empty side has method ``none`` and no drift; columns of
    other types are not tested.

    The values of both sides are counted once, into a table that the choice (one
    row a column) and all tests read."""
    cfg = config if isinstance(config, DriftConfig) else DriftConfig.from_dict(config)
    spark = reference.sparkSession
    cat, num, _ = route_columns(reference, common_columns(reference, current), cfg)
    types = {f.name: f.dataType for f in current.schema.fields}
    num = [c for c in num if isinstance(types[c], _NUMERIC)]
    path = scratch_path(spark, "preset")
    parts = [side_counts(reference, current, cols, kind).select("column", F.col("value").cast("string").alias("text"), number.alias("value"), "n_ref", "n_cur")
             for cols, kind, number in ((cat, "string", F.lit(None).cast("double")), (num, "double", F.col("value"))) if cols]
    empty = spark.createDataFrame([], "column string, text string, value double, n_ref long, n_cur long")
    reduce(DataFrame.unionByName, parts, empty).write.parquet(path)
    counts = spark.read.parquet(path)
    facts = {r["column"]: r for r in counts.groupBy("column").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"), F.count(F.lit(1)).alias("n_values")).collect()}

    def method(c: str) -> str:
        f = facts.get(c)
        if f is None or not f["tot_ref"] or not f["tot_cur"]:
            return "none"
        small, few = f["tot_ref"] <= PRESET_SMALL, c in cat or f["n_values"] <= PRESET_FEW
        if few:
            return ("z_test" if f["n_values"] <= 2 else "chi_square") if small else "jensen_shannon"
        return "ks_test" if small else "wasserstein"

    rows = [(c, method(c), *([f["tot_ref"], f["tot_cur"], f["n_values"]] if (f := facts.get(c)) else [0, 0, 0])) for c in sorted([*cat, *num])]
    chosen = spark.createDataFrame(rows, "column string, method string, n_reference long, n_current long, n_values long")
    totals = F.broadcast(chosen.select("column", F.col("n_reference").alias("tot_ref"), F.col("n_current").alias("tot_cur")))

    def by(name: str) -> DataFrame:
        return counts.where(F.col("column").isin([c for c, m, *_ in rows if m == name]))

    results = []
    for name in sorted({m for _, m, *_ in rows} - {"none"}):
        own = by(name)
        numbers, texts = own.drop("text"), own.select("column", F.col("text").alias("value"), "n_ref", "n_cur").join(totals, "column")
        if name == "ks_test":
            tested = ks_statistics(numbers, totals).withColumn("p_value", ks_pvalue(F.col("statistic"), F.col("tot_ref"), F.col("tot_cur")))
        elif name == "chi_square":
            tested = _chi_square(texts)
        elif name == "z_test":
            tested = _proportions(texts)
        elif name == "wasserstein":
            mean = numbers.groupBy("column").agg((F.sum(F.col("value") * F.col("n_ref")) / F.sum("n_ref")).alias("mean"))
            spread = F.sqrt(F.sum(F.pow(F.col("value") - F.col("mean"), 2) * F.col("n_ref")) / F.sum("n_ref"))
            deviation = numbers.join(F.broadcast(mean), "column").groupBy("column").agg(spread.alias("sd"))
            tested = wasserstein_distances(numbers, totals).join(F.broadcast(deviation), "column") \
                .withColumn("statistic", F.try_divide(F.col("wasserstein"), F.greatest(F.col("sd"), F.lit(0.001))))
        else:
            js = js_term(safe_div(F.col("n_ref"), F.col("tot_ref")), safe_div(F.col("n_cur"), F.col("tot_cur")))
            tested = texts.groupBy("column").agg(F.sqrt(F.greatest(F.sum(js), F.lit(0.0)) / math.log(2)).alias("statistic"))
        p = F.col("p_value") if "p_value" in tested.columns else F.lit(None).cast("double")
        results.append(tested.select("column", F.col("statistic").cast("double").alias("statistic"), p.alias("p_value")))
    none = spark.createDataFrame([], "column string, statistic double, p_value double")
    tested = reduce(DataFrame.unionByName, results, none)
    distance = F.col("method").isin("wasserstein", "jensen_shannon")
    drifted = F.when(distance, F.col("statistic") >= PRESET_DISTANCE).otherwise(F.col("p_value") < cfg.drift_threshold)
    columns = chosen.join(F.broadcast(tested), "column", "left").select(
        "column", "method", "statistic", "p_value", "n_reference", "n_current", "n_values", F.coalesce(drifted, F.lit(False)).alias("drift_detected"))
    return PresetResult(columns, drift_summary(columns, len(rows), PRESET_OVERALL))


# ---------------------------------------------------------------- whole table

@dataclass
class DriftResult:
    columns: DataFrame          # DRIFT_COLUMNS_SCHEMA
    summary: DataFrame          # one row
    mismatch: DataFrame         # (column, side)


def reference_profile(reference: DataFrame, config: dict | DriftConfig | None, path: str) -> str:
    """Write the reference's per-value counts once: ``<path>/categorical``
    (column, value string, n_ref) and ``<path>/numeric`` (column, value
    double, n_ref), so later ``detect_drift(..., profile_path=path)`` calls
    scan only the current table."""
    cfg = config if isinstance(config, DriftConfig) else DriftConfig.from_dict(config)
    cat, num, _ = route_columns(reference, list(reference.columns), cfg)
    for kind, cols, typ in (("categorical", cat, "string"), ("numeric", num, "double")):
        schema = f"column string, value {typ}, n_ref long"
        if cols:
            long = _long(reference, cols, typ, 1)
            long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_ref")) \
                .write.mode("overwrite").parquet(f"{path}/{kind}")
        else:
            reference.sparkSession.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{kind}")
    routing = json.dumps({"categorical": cat, "numeric": num})
    reference.sparkSession.createDataFrame([(routing,)], "r string").coalesce(1).write.mode("overwrite").text(f"{path}/routing")
    return path


def profile_routing(spark: SparkSession, path: str) -> dict | None:
    """The columns of each kind in a stored profile; None where there is none."""
    try:
        return json.loads(spark.read.text(f"{path}/routing").first()[0])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def detect_drift(reference: DataFrame, current: DataFrame, config: dict | DriftConfig | None = None,
                 profile_path: str | None = None) -> DriftResult:
    """Per-column drift over the common columns plus the overall verdict.

    total_columns counts every common column, the skipped datetime column
    included; tested_columns counts the columns that got a test."""
    cfg = config if isinstance(config, DriftConfig) else DriftConfig.from_dict(config)
    spark = reference.sparkSession
    common = common_columns(reference, current)
    cat, num, bad = route_columns(reference, common, cfg)
    # A numeric reference column that is not numeric in the current table
    # cannot be compared: report it as an error row instead of failing.
    cur_types = {f.name: f.dataType for f in current.schema.fields}
    mismatched = [c for c in num if not isinstance(cur_types[c], _NUMERIC)]
    num = [c for c in num if c not in mismatched]
    bad = bad + [(c, f"{dict((f.name, f.dataType) for f in reference.schema.fields)[c].simpleString()} "
                     f"vs {cur_types[c].simpleString()}") for c in mismatched]
    if profile_path:
        # Stored reference counts: only the current table is scanned.
        stored = profile_routing(spark, profile_path)
        unknown = sorted((set(cat) - set(stored["categorical"])) | (set(num) - set(stored["numeric"])))
        if unknown:
            raise ValueError(f"the stored reference profile does not hold {', '.join(unknown)} as they are compared now; rebuild it")
        pc = spark.read.parquet(f"{profile_path}/categorical")
        pn = spark.read.parquet(f"{profile_path}/numeric")
        parts = [categorical_drift(reference, current, cat, cfg.js_divergence_threshold, profile=pc),
                 numeric_drift(reference, current, num, cfg.drift_threshold, ks_method=cfg.ks_method,
                               profile=pn)]
    else:
        # One pair of global aggregates gives the non-null totals of every tested
        # column, computed once: one row per column, shared by both halves.
        totals = side_totals(reference, current, cat + num) if cat + num else None
        totals = totals and spark.createDataFrame(totals.collect(), totals.schema)
        parts = [categorical_drift(reference, current, cat, cfg.js_divergence_threshold, totals),
                 numeric_drift(reference, current, num, cfg.drift_threshold, totals, cfg.ks_method)]
    if bad:
        parts.append(spark.createDataFrame(
            [(c, "unsupported", "none", None, None, None, None, None, False, f"unsupported type {t}")
             for c, t in bad], DRIFT_COLUMNS_SCHEMA))
    columns = parts[0]
    for p in parts[1:]:
        columns = columns.unionByName(p)
    summary = drift_summary(columns, total_columns=len(common),
                            overall_threshold=cfg.overall_drift_threshold)
    return DriftResult(columns=columns, summary=summary, mismatch=column_mismatch(reference, current))


def drift_summary(columns: DataFrame, total_columns: int,
                  overall_threshold: float = DEFAULT_OVERALL_DRIFT_THRESHOLD) -> DataFrame:
    agg = columns.agg(F.count_if(F.col("drift_detected")).cast("long").alias("columns_drifted"),
                      F.count(F.lit(1)).cast("long").alias("tested_columns"))
    score = F.when(F.lit(total_columns) > 0,
                   F.col("columns_drifted") / F.lit(float(total_columns))).otherwise(F.lit(0.0))
    return agg.select(
        "columns_drifted", "tested_columns",
        F.lit(total_columns).cast("long").alias("total_columns"),
        score.alias("drift_score"),
        (score >= F.lit(overall_threshold)).alias("data_drift_detected"))


def drifted_columns(columns: DataFrame) -> DataFrame:
    """Names of drifted columns: the retraining signal."""
    return columns.where(F.col("drift_detected")).select("column")


def rounded(columns: DataFrame) -> DataFrame:
    """Drift rows with floating results rounded to 9 decimals (reporting and
    comparison form)."""
    return columns.select(*[round9(F.col(c)).alias(c) if c in ("statistic", "p_value", "js_divergence")
                            else F.col(c) for c in columns.columns])


class DataDriftMonitor:
    """Holds a reference table and compares current tables against it."""

    def __init__(self, spark: SparkSession, config: dict | None = None):
        self.spark = spark
        self.config = dict(config or {})
        self.reference: DataFrame | None = None
        self.profile_path: str | None = None
        path = self.config.get("reference_data_path")
        if path:
            self.load_reference_data(path)
            if self.config.get("reference_profile_path"):
                self.use_reference_profile(self.config["reference_profile_path"])

    def load_reference_data(self, path: str | None = None) -> DataFrame:
        from tidemark.sources.readers import read_by_extension
        path = path or self.config.get("reference_data_path")
        if not path:
            raise ValueError("no reference_data_path configured")
        self.reference = read_by_extension(self.spark, path)
        return self.reference

    def set_reference(self, df: DataFrame) -> None:
        self.reference = df
        self.profile_path = None

    def use_reference_profile(self, path: str) -> str:
        """Use the profile stored at ``path``, building it where there is none.
        A profile with other columns or kinds than the configuration gives is
        an error: ``build_reference_profile`` replaces it."""
        cfg = DriftConfig.from_dict(self.config)
        cat, num, _ = route_columns(self.reference, list(self.reference.columns), cfg)
        stored = profile_routing(self.spark, path)
        if stored is None:
            return self.build_reference_profile(path)
        if (sorted(stored["categorical"]), sorted(stored["numeric"])) != (sorted(cat), sorted(num)):
            raise ValueError(f"the reference profile at {path} was built for other columns; rebuild it")
        self.profile_path = path
        return path

    def build_reference_profile(self, path: str | None = None) -> str:
        """Store the reference's per-value counts (config key
        ``reference_profile_path``); later comparisons scan only current data."""
        if self.reference is None:
            raise ValueError("load or set a reference table first")
        path = path or self.config.get("reference_profile_path")
        if not path:
            raise ValueError("No path for the reference profile")
        self.profile_path = reference_profile(self.reference, self.config, path)
        return self.profile_path

    def detect_drift(self, current: DataFrame) -> DriftResult:
        if self.reference is None:
            raise ValueError("load or set a reference table first")
        return detect_drift(self.reference, current, self.config, getattr(self, "profile_path", None))
