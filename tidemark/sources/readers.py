"""Table sources: CSV / Parquet / JSON scans with the missing-value and type
rules of the monitored pipelines, reference/current readers keyed on file
extension, and the baseline-metrics reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.csv_ranges import bit_maps, first_bits, records

# The default missing-value tokens of pandas' CSV reader.
CSV_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Spellings pandas' CSV reader takes as booleans.
CSV_TRUE_TOKENS = ["True", "TRUE", "true"]
CSV_FALSE_TOKENS = ["False", "FALSE", "false"]

SOURCE_TYPES = ("csv", "parquet", "json")


def resolve_source(config: dict) -> tuple[str, str | list[str]]:
    """(source_type, path) from an ingestion config: ``input_path`` overrides
    ``source_path`` (``data_source`` and ``data_path`` accepted as aliases); a
    list of paths is read whole."""
    source_type = config.get("source_type", "csv")
    path = (config.get("input_path") or config.get("source_path") or config.get("data_source")
            or config.get("data_path"))
    if not path:
        raise ValueError("ingestion config names no input path (input_path or source_path)")
    # Paths go to Spark as they are: a URI scheme must survive.
    path = [str(p) for p in path] if isinstance(path, list) else str(path)
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"source type {source_type!r} is not one of {', '.join(SOURCE_TYPES)}")
    return source_type, path


def read_table(spark: SparkSession, config: dict) -> DataFrame:
    """Load a table as the data pipeline's ingestion step does."""
    source_type, path = resolve_source(config)
    if source_type == "csv":
        return read_csv(spark, path)
    if source_type == "parquet":
        return nan_to_null(spark.read.parquet(*(path if isinstance(path, list) else [path])))
    return read_json(spark, path, lines=bool(config.get("lines", False)))


def read_by_extension(spark: SparkSession, path: str) -> DataFrame:
    """Reference / current dataset reader: .csv or .parquet by extension."""
    ext = str(path).rstrip("/").rpartition("/")[2].rpartition(".")[2].lower()
    if ext == "csv":
        return read_csv(spark, path)
    if ext == "parquet":
        return nan_to_null(spark.read.parquet(path))
    raise ValueError(f"cannot tell the format of {path!r}: expected .csv or .parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL on float/double columns, so that every operator
    reasons about one kind of missing value."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cols.append(F.when(F.isnan(qcol(f.name)), F.lit(None).cast(f.dataType))
                        .otherwise(qcol(f.name)).alias(f.name))
        else:
            cols.append(qcol(f.name))
    return df.select(*cols)


# A decimal number or an infinity; Spark's cast alone also takes type suffixes ("1D").
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(inf|Inf|INF|infinity|Infinity|INFINITY)\s*$"


def _is_number(v):
    return v.rlike(NUMBER_PATTERN) & v.try_cast("double").isNotNull()


def _infer_and_cast(df: DataFrame) -> DataFrame:
    """Strings -> long / double / boolean / string per column, chosen by one
    aggregate pass over the table (no driver-side sampling)."""
    if not df.columns:
        return df
    checks = []
    for c in df.columns:
        v = qcol(c)
        present = v.isNotNull()
        checks += [
            F.count_if(present & v.try_cast("bigint").isNull()).alias(f"{c}\x00l"),
            F.count_if(present & ~_is_number(v)).alias(f"{c}\x00d"),
            F.count_if(present & ~v.isin(CSV_TRUE_TOKENS + CSV_FALSE_TOKENS)).alias(f"{c}\x00b"),
            F.count_if(present).alias(f"{c}\x00n"),
        ]
    stats = df.agg(*checks).first()  # one row, four numbers per column
    out = []
    for c in df.columns:
        v = qcol(c)
        if stats[f"{c}\x00n"] == 0:
            out.append(v.cast("double").alias(c))          # all missing -> float, as pandas
        elif stats[f"{c}\x00l"] == 0:
            out.append(v.cast("bigint").alias(c))
        elif stats[f"{c}\x00d"] == 0:
            d = v.cast("double")
            out.append(F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d).alias(c))
        elif stats[f"{c}\x00b"] == 0:
            out.append(v.isin(CSV_TRUE_TOKENS).alias(c))
        else:
            out.append(v.alias(c))
    return df.select(*out)


def read_csv(spark: SparkSession, path) -> DataFrame:
    """CSV with a header row: every cell read as text, pandas' NA tokens
    mapped to NULL, then each column cast to the narrowest of long, double,
    boolean or string that holds all its values. A doubled quote inside quotes
    is one quote, and a quoted cell may hold line breaks.

    Files are split over tasks either way. A first pass looks for records of
    several lines; without any, Spark's line reader takes the files, otherwise
    each byte range owns the records that start in it (``csv_ranges``)."""
    options = {"header": True, "inferSchema": False, "escape": '"'}
    ensure_checkpoint_dir(spark)
    maps = bit_maps(spark, path).checkpoint(eager=True)  # one row a byte range
    if not maps.where("crossed").isEmpty():
        names = spark.read.options(**options, multiLine=True).csv(path).columns  # reads the first record
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        rows = records(spark, path, first_bits(maps))
        raw = rows.select(F.from_csv("record", schema, {"escape": '"', "multiLine": "true"}).alias("r")).select("r.*")
    else:
        raw = spark.read.options(**options).csv(path)
    cleaned = raw.select(*[F.when(qcol(c).isin(CSV_NA_TOKENS) | qcol(c).isNull(),
                                  F.lit(None).cast("string")).otherwise(qcol(c)).alias(c)
                           for c in raw.columns])
    return _infer_and_cast(cleaned)


def _first_sign(spark: SparkSession, path) -> str:
    """The first character of the first file that is no white space ('' if none),
    read through Spark's file systems."""
    files = spark.read.text(path).inputFiles()
    if not files:
        return ""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0]))
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        while (c := stream.read()) >= 0:
            if chr(c) not in " \t\r\n":
                return chr(c)
        return ""
    finally:
        stream.close()


def _cell_types(cells: DataFrame, texts: DataFrame) -> dict[str, str]:
    """SQL type of each column: long, double, boolean or string, whichever holds
    all its values, in the order of the documents' keys (one row a column)."""
    kinds = {r["column"]: r["kind"] for r in cells.groupBy("column").agg(F.expr("schema_of_variant_agg(value)").alias("kind")).collect()}
    keys = texts.select(F.posexplode(F.json_object_keys("value")).alias("place", "column")).groupBy("column").agg(F.min("place").alias("place"))
    types = {"BIGINT": "bigint", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean", "VOID": "double"}
    names = [r["column"] for r in keys.orderBy("place", "column").collect()]
    return {c: types.get(kinds[c].split("(")[0].split("<")[0], "string") for c in names if c in kinds}


def read_json_columns(spark: SparkSession, path) -> DataFrame:
    """A table from column-oriented objects, ``{"column": {"row": value}}`` or
    ``{"column": [value, ...]}``; each file is one object and its own set of rows.

    An object becomes a VARIANT, is exploded by column and by row, and the cells
    are put together by row key, so no schema has a field a row. A VARIANT holds
    the names of its whole document; the casts to maps and arrays give every
    cell its own, so that time and memory follow the text. Columns come in
    the order of the objects; a row without a cell in a column has NULL there.
    Long, double, boolean or string is chosen by all values of a column (mixed
    and nested ones are text; a column of nulls is double). Raises ValueError
    for an object whose members are neither objects nor arrays. A file is one
    row here, so it may be as large as a VARIANT (Spark's own limit); larger
    tables should come as many files, or as JSON lines."""
    texts = spark.read.text(path, wholetext=True)
    whole = texts.select(F.col("_metadata.file_path").alias("file"), F.parse_json("value").alias("v"))
    by_name, by_place = "map<string, variant>", "array<variant>"
    members = whole.select("file", (F.size(F.try_variant_get("v", "$", by_place)) > 0).alias("records"),
                           F.explode_outer(F.try_variant_get("v", "$", by_name)).alias("column", "cells"))
    named, placed = F.try_variant_get("cells", "$", by_name), F.try_variant_get("cells", "$", by_place)
    if not members.where(F.col("records") | F.col("column").isNotNull() & named.isNull() & placed.isNull()).isEmpty():
        raise ValueError(f"{path}: neither an array of records nor columns of values")
    numbered = F.transform(placed, lambda value, i: F.struct(i.cast("string").alias("key"), value.alias("value")))
    cells = members.select("file", "column", F.inline(F.coalesce(F.map_entries(named), numbered))).withColumnRenamed("key", "row")
    types = _cell_types(cells, texts)
    if not types:
        return spark.createDataFrame([], T.StructType([]))
    rows = cells.groupBy("file", "row").agg(*[
        F.max(F.when(F.col("column") == c, F.try_variant_get("value", "$", t))).alias(c) for c, t in types.items()])
    return nan_to_null(rows.select(*[qcol(c) for c in types]))


def read_json(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """JSON lines when ``lines`` is true; otherwise one JSON document a file: an
    array of records, or an object of columns (:func:`read_json_columns`), as
    the first file begins. Integral numbers come back as long."""
    if not lines and _first_sign(spark, path) == "{":
        return read_json_columns(spark, path)
    reader = spark.read
    if not lines:
        reader = reader.option("multiLine", True)
    return nan_to_null(reader.json(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Baseline metrics: a flat JSON object name -> number, returned as
    (metric string, value double) rows. A Parquet metric table with those two
    columns is accepted as well."""
    if str(path).rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(F.col("metric").cast("string"),
                                                F.col("value").cast("double"))
    obj = spark.read.option("multiLine", True).json(path)
    cols = obj.columns
    if not cols:
        return spark.createDataFrame([], "metric string, value double")
    wide = obj.select(*[qcol(c).cast("double").alias(c) for c in cols])
    return wide.unpivot([], [qcol(c) for c in cols], "metric", "value")
