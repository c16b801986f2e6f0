"""Data quality: null counts, duplicate rows, declared-type checks and the
validation verdict. Each check is a single aggregate job over the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol

# Pandas dtype names for Spark types, as used by declared schemas.
PANDAS_DTYPE = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "boolean": "bool",
    "string": "object",
    "binary": "object",
    "date": "object",
    "timestamp": "datetime64[ns]",
    "timestamp_ntz": "datetime64[ns]",
}


def pandas_dtype(t: T.DataType) -> str:
    """The pandas dtype name a column of Spark type ``t`` would have."""
    name = t.simpleString()
    if isinstance(t, T.DecimalType) or name not in PANDAS_DTYPE:
        return "object"
    return PANDAS_DTYPE[name]


def _is_missing(f: T.StructField) -> F.Column:
    c = qcol(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """(column, null_count): missing values per column, one aggregate job.
    NaN counts as missing, as in pandas."""
    fields = df.schema.fields
    if not fields:
        return df.sparkSession.createDataFrame([], "column string, null_count long")
    wide = df.agg(*[F.count_if(_is_missing(f)).cast("long").alias(f.name) for f in fields])
    return wide.unpivot([], [qcol(f.name) for f in fields], "column", "null_count")


def duplicate_stats(df: DataFrame) -> DataFrame:
    """One row (n_rows, distinct_rows, duplicate_rows): rows equal to an
    earlier row, NULLs equal to each other. A single grouped aggregation with
    a map-side partial count, so hot duplicates shrink before the shuffle."""
    groups = df.groupBy(*[qcol(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def type_check(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """(column, expected, actual, matches, n_nonconforming) for the declared
    columns that are present; absent declared columns are ignored.
    ``expected`` is a pandas dtype name (or a Spark type name); ``actual`` is
    the pandas name of the column's Spark type; n_nonconforming counts the
    non-null values that would not cast to the expected type."""
    fields = {f.name: f for f in df.schema.fields}
    checked = [(c, e) for c, e in dtypes.items() if c in fields]
    spark = df.sparkSession
    schema = ("column string, expected string, actual string, matches boolean, "
              "n_nonconforming long")
    if not checked:
        return spark.createDataFrame([], schema)
    spark_name = {v: k for k, v in PANDAS_DTYPE.items() if k not in ("timestamp_ntz",)}
    spark_name.update({"object": "string", "datetime64[ns]": "timestamp"})
    aggs = []
    for c, e in checked:
        target = spark_name.get(e, e)
        try:
            T._parse_datatype_string(target)
        except Exception:  # noqa: BLE001 - unknown name: nothing conforms
            target = None
        col = qcol(c)
        bad = (col.isNotNull() & col.try_cast(target).isNull()) if target else col.isNotNull()
        aggs.append(F.count_if(bad).cast("long").alias(c))
    counts = df.agg(*aggs).unpivot([], [qcol(c) for c, _ in checked], "column", "n_nonconforming")
    meta = spark.createDataFrame(
        [(c, e, pandas_dtype(fields[c].dataType),
          e in (pandas_dtype(fields[c].dataType), fields[c].dataType.simpleString()))
         for c, e in checked],
        "column string, expected string, actual string, matches boolean")
    return meta.join(F.broadcast(counts), "column").select(*[s.split()[0] for s in schema.split(", ")])


@dataclass
class ValidationResult:
    is_valid: bool
    nulls: DataFrame        # (column, null_count)
    types: DataFrame        # type_check rows
    summary: DataFrame      # (n_rows, n_cols, duplicate_rows, is_valid)
    duplicate_rows: int
    types_match: bool
    n_rows: int

    def as_dict(self) -> dict:
        return {
            "missing_values": {r["column"]: r["null_count"] for r in self.nulls.collect()},
            "duplicate_rows": self.duplicate_rows,
            "type_check": {r["column"]: {"expected": r["expected"], "actual": r["actual"],
                                         "matches": r["matches"]} for r in self.types.collect()},
        }


def validation_summary(df: DataFrame, dtypes: dict[str, str] | None = None) -> DataFrame:
    """One row (n_rows, n_cols, duplicate_rows, is_valid). Invalid iff a row
    is duplicated or a declared type differs; NULLs never invalidate."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    types_ok = all(e in (pandas_dtype(fields[c]), fields[c].simpleString())
                   for c, e in (dtypes or {}).items() if c in fields)
    dup = duplicate_stats(df)
    return dup.select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"), "duplicate_rows",
        ((F.col("duplicate_rows") == 0) & F.lit(types_ok)).alias("is_valid"))


def validate(df: DataFrame, schema: dict | None = None) -> ValidationResult:
    """Null counts + duplicates + declared types; ``schema`` is
    ``{"dtypes": {column: dtype}}``. The tables of the result are a few rows
    each, computed once."""
    dtypes = dict((schema or {}).get("dtypes", {}) or {})
    spark = df.sparkSession

    def once(t: DataFrame) -> DataFrame:
        return spark.createDataFrame(t.collect(), t.schema)

    summary = once(validation_summary(df, dtypes))
    row = summary.first()
    types = once(type_check(df, dtypes))
    fields = {f.name: f.dataType for f in df.schema.fields}
    types_ok = all(e in (pandas_dtype(fields[c]), fields[c].simpleString())
                   for c, e in dtypes.items() if c in fields)
    return ValidationResult(is_valid=bool(row["is_valid"]), nulls=once(null_counts(df)), types=types,
                            summary=summary, duplicate_rows=int(row["duplicate_rows"]),
                            types_match=types_ok, n_rows=int(row["n_rows"]))


def missing_share(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """(column, null_count, n_rows, missing_share, above_threshold): the
    declared missing-value check (share of missing values > threshold)."""
    fields = df.schema.fields
    wide = df.agg(F.count(F.lit(1)).alias("\x00n"),
                  *[F.count_if(_is_missing(f)).cast("long").alias(f.name) for f in fields])
    long = wide.unpivot(["\x00n"], [qcol(f.name) for f in fields], "column", "null_count")
    share = F.try_divide(F.col("null_count").cast("double"), F.col("\x00n"))
    return long.select("column", "null_count", F.col("\x00n").cast("long").alias("n_rows"),
                       share.alias("missing_share"),
                       F.coalesce(share > F.lit(threshold), F.lit(False)).alias("above_threshold"))


def outlier_counts(df: DataFrame, columns: list[str], z: float = 3.0) -> DataFrame:
    """(column, n_outliers): values with |x - mean| / sample std > z, per
    numeric column. NaN counts as missing. Mean and std come from one
    aggregate (one row, used as literals); the count is a second one."""
    def value(c):
        x = qcol(c).cast("double")
        return F.when(~F.isnan(x), x)

    stats = df.agg(*[f(value(c)).alias(f"{k}{i}") for i, c in enumerate(columns)
                     for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    counts = df.agg(*[F.count_if(F.abs(F.try_divide(value(c) - F.lit(stats[f"m{i}"]).cast("double"),
                                                    F.lit(stats[f"s{i}"]).cast("double")))
                                 > F.lit(z)).cast("long").alias(c) for i, c in enumerate(columns)])
    return counts.unpivot([], [qcol(c) for c in columns], "column", "n_outliers")
