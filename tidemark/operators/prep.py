"""Feature preparation: an ordered list of steps, each a DataFrame ->
DataFrame function whose statistics are fitted on the previous step's output.

``fit_transform(df, steps)`` returns the prepared table and a ``FittedSteps``
holding the fitted state (small literals, or a code table for label
encoding), which ``transform`` reapplies to new data."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol
from tidemark.operators.ordered import dense_codes, exact_medians
from tidemark.sources.readers import nan_to_null

STEP_TYPES = ("drop_duplicates", "encode_categorical", "scale_numerical",
              "fill_missing", "drop_columns", "polynomial_features")
LABEL_METHODS = ("label", "label_encode")
FILL_METHODS = ("mean", "median", "mode", "constant")
KEEP_CODE_ROWS = 2_000_000  # a join with more codes than this is worth keeping while later steps are fitted

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, _NUMERIC)


# ---------------------------------------------------------------- U1, P1

def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Map columns cannot be compared, so they are refused."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if maps:
        raise ValueError(f"drop_duplicates cannot compare map columns: {maps}")
    return df.dropDuplicates()


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


# ---------------------------------------------------------------- F2 label codes

@dataclass
class LabelCodes:
    column: str
    codes: DataFrame          # (value, code), one row a distinct non-null value
    n_codes: int
    null_seen: bool


def fit_label_codes(df: DataFrame, column: str) -> LabelCodes:
    """Codes 0..k-1 in ascending value order; NULL, if present, gets k. The
    distinct values are ranked on the cluster (``ordered.dense_codes``),
    however many there are."""
    codes = dense_codes(df, column)
    nulls = df.where(qcol(column).isNull()).limit(1).count()
    return LabelCodes(column, codes, codes.count(), bool(nulls))  # the codes are checkpointed: a cheap count


def apply_label_codes(df: DataFrame, lc: LabelCodes, unseen: str = "error") -> DataFrame:
    """Replace the column with its code as double. A value unseen at fit
    (or a NULL when none was seen) fails the job, as the fitted encoder would;
    with ``unseen="null"`` an unseen value's code is NULL.

    The codes are joined at every size; the planner broadcasts them when their
    bytes allow it. NULL rows carry a salt as a second join key, so that a
    shuffled join spreads them."""
    c = lc.column
    null_code = F.lit(lc.n_codes) if lc.null_seen else F.raise_error(
        F.lit(f"column {c}: NULL was not among the fitted labels"))
    missed = F.lit(None) if unseen == "null" else F.raise_error(F.concat(F.lit(f"column {c}: not among the fitted labels: "), qcol(c).cast("string")))
    hashable = [qcol(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.when(qcol(c).isNull(), F.pmod(F.xxhash64(*hashable), F.lit(1024)) + 1).otherwise(F.lit(0))
    codes = lc.codes.select(F.col("value").alias("_lv"), F.col("code").alias("_lc"), F.lit(0).cast("long").alias("_lz"))
    looked = df.withColumn("_ls", salt.cast("long"))
    looked = looked.join(codes, (qcol(c) == F.col("_lv")) & (F.col("_ls") == F.col("_lz")), "left")
    code = (F.when(qcol(c).isNull(), null_code)
            .when(F.col("_lc").isNull(), missed)
            .otherwise(F.col("_lc"))).cast("double")
    return looked.select(*[code.alias(c) if x == c else qcol(x) for x in df.columns])


# ---------------------------------------------------------------- F3 one-hot

def fit_one_hot(df: DataFrame, column: str, drop_first: bool = False,
                max_categories: int | None = None) -> list:
    """Sorted distinct non-null values (each becomes a column of the schema).
    With ``max_categories``, more of them are an error."""
    vals = df.select(qcol(column).alias("v")).where(F.col("v").isNotNull()).distinct()
    if max_categories is not None:
        vals = vals.limit(max_categories + 1)
    vals = vals.collect()
    if max_categories is not None and len(vals) > max_categories:
        raise ValueError(f"one-hot on {column}: more than {max_categories} categories")
    cats = sorted(r["v"] for r in vals)
    return cats[1:] if drop_first else cats


def apply_one_hot(df: DataFrame, column: str, categories: list) -> DataFrame:
    """Drop the column and append ``<column>_<value>`` 0/1 int columns in
    category order; NULL and unseen values give all zeros."""
    rest = [qcol(x) for x in df.columns if x != column]
    ind = [F.when(qcol(column) == F.lit(v), 1).otherwise(0).alias(f"{column}_{v}") for v in categories]
    return df.select(*rest, *ind)


@dataclass
class OneHotCodes:
    codes: LabelCodes
    drop_first: bool


def fit_one_hot_codes(df: DataFrame, column: str, drop_first: bool = False) -> OneHotCodes:
    """Positions of the categories of ``column`` in ascending order, ranked on the
    cluster however many there are; only their number reaches the driver."""
    return OneHotCodes(fit_label_codes(df, column), drop_first)


def apply_one_hot_vector(df: DataFrame, fitted: OneHotCodes, out: str | None = None) -> DataFrame:
    """Drop the column and append ``out`` (``<column>_vector`` unless given), a
    sparse ML vector with a one at the row's category: for any number of
    categories, with no schema column or literal for each. NULL and unseen values,
    and the first category under ``drop_first``, give a vector of zeros; a column
    without any category gives vectors of size 0."""
    c, first = fitted.codes.column, int(fitted.drop_first)
    out = out or f"{c}_vector"
    size = max(fitted.codes.n_codes - first, 0)
    known = replace(fitted.codes, null_seen=True)  # NULL has the code after the last
    looked = apply_label_codes(df.withColumn("_oh", qcol(c)), replace(known, column="_oh"), unseen="null")
    place = F.when(F.col("_oh") >= first, F.col("_oh") - first)
    place = F.coalesce(place, F.lit(float(size)))  # the last category is the one that the encoder drops
    rest = [qcol(x) for x in df.columns if x not in (c, out)]
    rows = looked.select(*rest, place.alias("_place"))
    if not size:
        return rows.select(*rest, array_to_vector(F.array().cast("array<double>")).alias(out))
    last = df.sparkSession.createDataFrame([(float(size),)], "_place double")
    encoder = OneHotEncoder(inputCols=["_place"], outputCols=[out], dropLast=True).fit(last)
    return encoder.transform(rows).drop("_place")


def one_hot_long(df: DataFrame, key_cols: list[str], columns: list[str]) -> DataFrame:
    """(keys..., column, category string): one row a non-null value, the ones of
    the one-hot table without its zeros; no category need be known beforehand."""
    cast = df.select(*[qcol(k) for k in key_cols], *[qcol(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)])
    names = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (f"_v{i}", c)])
    long = cast.unpivot([qcol(k) for k in key_cols], [f"_v{i}" for i in range(len(columns))], "_c", "category").where("category IS NOT NULL")
    return long.select(*[qcol(k) for k in key_cols], names[F.col("_c")].alias("column"), "category")


# ---------------------------------------------------------------- F4 scaling

def fit_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """(mean, sample std) per present numeric column; one aggregate job."""
    types = _types(df)
    cols = [c for c in columns if c in types and _is_numeric(types[c])]
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = qcol(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def apply_scale(df: DataFrame, stats: dict[str, tuple]) -> DataFrame:
    """(x - mean) / std; a zero or undefined std gives NULL."""
    out = []
    for x in df.columns:
        if x in stats:
            mean, std = stats[x]
            v = F.try_divide(qcol(x).cast("double") - F.lit(mean).cast("double"),
                             F.lit(std).cast("double"))
            out.append(v.alias(x))
        else:
            out.append(qcol(x))
    return df.select(*out)


# ---------------------------------------------------------------- F5 filling

def _modes(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent value per column, the smallest among ties; one grouped
    job per value family (integral / fractional / other), with map-side
    partial counts and a partial min per column."""
    types = _types(df)
    fams = {"bigint": [], "double": [], "string": []}
    for c in cols:
        t = types[c]
        if isinstance(t, _INTEGRAL + (T.BooleanType,)):
            fams["bigint"].append(c)
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            fams["double"].append(c)
        else:
            fams["string"].append(c)
    found: dict = {}
    for typ, names in fams.items():
        if not names:
            continue
        long = (df.select(*[qcol(c).cast(typ).alias(c) for c in names])
                .unpivot([], [qcol(c) for c in names], "column", "value").where(F.col("value").isNotNull()))
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(
            F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("b"))
        for r in best.collect():  # one row per column
            found[r["column"]] = r["b"]["value"]
    return found


def fit_fill(df: DataFrame, columns: list[str] | None, method: str, value=0,
             approx: bool = False, accuracy: int = 10_000) -> dict:
    """Fill value per column. Mean/median of a named non-numeric column is an
    error; when columns default to all, such columns are skipped. The median
    is exact unless ``approx`` (one ``percentile_approx`` aggregate, rank
    error about 1/accuracy)."""
    if method not in FILL_METHODS:
        raise ValueError(f"fill method {method!r} is not one of {', '.join(FILL_METHODS)}")
    types = _types(df)
    named = columns is not None
    cols = [c for c in (columns if named else df.columns) if c in types]
    if method == "constant":
        return {c: value for c in cols}
    if method in ("mean", "median"):
        bad = [c for c in cols if not _is_numeric(types[c])]
        if bad and named:
            raise TypeError(f"fill_missing {method} needs numeric columns: {bad}")
        cols = [c for c in cols if _is_numeric(types[c])]
        if not cols:
            return {}
        if method == "mean":
            row = df.agg(*[F.avg(qcol(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
            return {c: row[f"m{i}"] for i, c in enumerate(cols)}
        if approx:
            row = df.agg(*[F.percentile_approx(qcol(c).cast("double"), 0.5, accuracy).alias(f"m{i}")
                           for i, c in enumerate(cols)]).first()
            return {c: row[f"m{i}"] for i, c in enumerate(cols)}
        long = (df.select(*[qcol(c).cast("double").alias(c) for c in cols])
                .unpivot([], [qcol(c) for c in cols], "column", "value"))
        med = exact_medians(long)
        return {c: med.get(c) for c in cols}
    modes = _modes(df, cols)
    missing = [c for c in cols if c not in modes]
    if missing:
        raise KeyError(f"mode of an all-missing column: {missing}")
    return modes


def apply_fill(df: DataFrame, fills: dict, as_double: bool = False) -> DataFrame:
    """coalesce(column, fill) with the fill cast to the column type; with
    ``as_double`` (mean and median) an integral column becomes double."""
    types = _types(df)
    out = []
    for x in df.columns:
        if x in fills and fills[x] is not None:
            t, v = types[x], fills[x]
            if as_double and isinstance(t, _INTEGRAL):
                out.append(F.coalesce(qcol(x).cast("double"), F.lit(v).cast("double")).alias(x))
            else:
                out.append(F.coalesce(qcol(x), F.lit(v).cast(t)).alias(x))
        else:
            out.append(qcol(x))
    return df.select(*out)


# ---------------------------------------------------------------- products of columns

def polynomial_features(df: DataFrame, columns: list[str], degree: int = 2, interaction_only: bool = False) -> DataFrame:
    """Append the products of two to ``degree`` of the numeric columns as double
    columns named ``a*b``: all products with repetition, or without
    (``interaction_only``). A missing factor makes the product missing."""
    from itertools import combinations, combinations_with_replacement
    types = _types(df)
    cols = [c for c in columns if c in types and _is_numeric(types[c])]
    pick = combinations if interaction_only else combinations_with_replacement
    made = []
    for n in range(2, degree + 1):
        for names in pick(cols, n):
            product = qcol(names[0]).cast("double")
            for c in names[1:]:
                product = product * qcol(c).cast("double")
            made.append(product.alias("*".join(names)))
    return df.select(*[qcol(c) for c in df.columns], *made)


# ---------------------------------------------------------------- F1 chain

@dataclass
class FittedSteps:
    steps: list[dict]
    params: list = field(default_factory=list)

    def describe(self) -> str:
        """Fitted literals as JSON (code tables are summarised)."""
        def enc(p):
            if isinstance(p, dict):
                return {k: enc(v) for k, v in p.items()}
            if isinstance(p, LabelCodes):
                return {"column": p.column, "n_codes": p.n_codes, "null_seen": p.null_seen}
            return p
        return json.dumps([{"step": s, "params": enc(p)} for s, p in zip(self.steps, self.params)],
                          default=str)


def _check_step(step: dict) -> str:
    t = step.get("type")
    if t not in STEP_TYPES:
        raise ValueError(f"step type {t!r} is not one of {', '.join(STEP_TYPES)}")
    if t == "encode_categorical":
        m = step.get("method", "label")
        if m not in LABEL_METHODS + ("one_hot",):
            raise ValueError(f"encoding method {m!r} is neither label nor one_hot")
    return t


def fit_step(df: DataFrame, step: dict):
    t = _check_step(step)
    if t == "encode_categorical":
        present = [c for c in step.get("columns", []) if c in df.columns]
        if step.get("method", "label") == "one_hot":
            return {c: fit_one_hot(df, c, bool(step.get("drop_first", False)), step.get("max_categories"))
                    for c in present}
        return {c: fit_label_codes(df, c) for c in present}
    if t == "scale_numerical":
        return fit_scale(df, step.get("columns", []))
    if t == "fill_missing":
        return fit_fill(df, step.get("columns"), step.get("method", "mean"), step.get("value", 0),
                        bool(step.get("approx", False)), int(step.get("accuracy", 10_000)))
    return None


def apply_step(df: DataFrame, step: dict, params) -> DataFrame:
    t = _check_step(step)
    if t == "drop_duplicates":
        return drop_duplicates(df)
    if t == "drop_columns":
        return drop_columns(df, step.get("columns", []))
    if t == "polynomial_features":
        return polynomial_features(df, step.get("columns", []), int(step.get("degree", 2)), bool(step.get("interaction_only", False)))
    if t == "encode_categorical":
        for c, p in params.items():
            if c not in df.columns:
                continue
            df = apply_one_hot(df, c, p) if isinstance(p, list) else apply_label_codes(df, p)
        return df
    if t == "scale_numerical":
        return apply_scale(df, params)
    return apply_fill(df, params, step.get("method", "mean") in ("mean", "median"))


def steps_from_config(config: dict | None) -> list[dict]:
    """Steps from ``preprocessing.preprocessing_steps`` or a top-level
    ``preprocessing_steps`` (both shapes occur in published configs)."""
    config = config or {}
    pre = config.get("preprocessing")
    if isinstance(pre, dict) and "preprocessing_steps" in pre:
        return list(pre["preprocessing_steps"])
    return list(config.get("preprocessing_steps", []))


_STATEFUL = ("encode_categorical", "scale_numerical", "fill_missing")


def _adds_shuffle(step: dict, params) -> bool:
    """Steps whose output plan holds a wide shuffle of the whole table."""
    if step.get("type") == "drop_duplicates":
        return True
    if step.get("type") == "encode_categorical" and isinstance(params, dict):
        return any(isinstance(p, LabelCodes) and p.n_codes > KEEP_CODE_ROWS for p in params.values())
    return False


def fit_transform(df: DataFrame, steps: list[dict]) -> tuple[DataFrame, FittedSteps]:
    """Apply the steps in order, each fitted on the previous step's output.
    NaN counts as missing: it becomes NULL before the first step.

    Fitting runs a statistics job over the current plan. When an earlier step
    left a whole-table shuffle in that plan (de-duplication, a large code
    join), the table is persisted (memory and disk; lost blocks are recomputed
    from lineage) while the later steps are fitted, so the shuffle runs once
    for all fits and once more for the final output, not once per fit."""
    fitted = FittedSteps(steps=list(steps))
    df = nan_to_null(df)
    shuffled, kept = False, []
    try:
        for step in steps:
            if shuffled and step.get("type") in _STATEFUL:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(df)
                shuffled = False
            p = fit_step(df, step)
            fitted.params.append(p)
            df = apply_step(df, step, p)
            shuffled = shuffled or _adds_shuffle(step, p)
    finally:
        for k in kept:
            k.unpersist()
    return df, fitted


def transform(df: DataFrame, fitted: FittedSteps) -> DataFrame:
    """Re-apply fitted steps (training statistics) to new data; NaN is NULL."""
    df = nan_to_null(df)
    for step, p in zip(fitted.steps, fitted.params):
        df = apply_step(df, step, p)
    return df


def _encode_params(params, path: str, step_no: int):
    if isinstance(params, dict):
        return {k: _encode_params(v, path, step_no) for k, v in params.items()}
    if isinstance(params, LabelCodes):
        enc = {"__label_codes__": True, "column": params.column, "n_codes": params.n_codes,
               "null_seen": params.null_seen, "codes_path": f"{path}/codes/step{step_no}_{params.column}"}
        params.codes.write.mode("overwrite").parquet(enc["codes_path"])
        return enc
    return params


def _decode_params(spark, params):
    if isinstance(params, dict) and params.get("__label_codes__"):
        return LabelCodes(params["column"], spark.read.parquet(params["codes_path"]), params["n_codes"], params["null_seen"])
    if isinstance(params, dict):
        return {k: _decode_params(spark, v) for k, v in params.items()}
    return params


def save_fitted(fitted: FittedSteps, path: str) -> str:
    """Write fitted steps beside a model: ``<path>/params`` (one JSON row:
    the steps and their literals) and ``<path>/codes/...`` (large label-code
    tables), so new data is transformed with the training statistics."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    doc = json.dumps({"steps": fitted.steps,
                      "params": [_encode_params(p, path, i) for i, p in enumerate(fitted.params)]},
                     default=str)
    spark.createDataFrame([(doc,)], "doc string").coalesce(1).write.mode("overwrite").text(f"{path}/params")
    return path


def load_fitted(spark, path: str) -> FittedSteps:
    doc = json.loads(spark.read.text(f"{path}/params").first()[0])
    return FittedSteps(steps=doc["steps"], params=[_decode_params(spark, p) for p in doc["params"]])


class DataPreprocessor:
    """Config-driven front end: ``DataPreprocessor(cfg).preprocess(df)``."""

    def __init__(self, config: dict | None = None):
        self.config = dict(config or {})
        self.preprocessing_steps = steps_from_config(self.config)
        self.fitted: FittedSteps | None = None

    def preprocess(self, df: DataFrame) -> DataFrame:
        out, self.fitted = fit_transform(df, self.preprocessing_steps)
        return out
