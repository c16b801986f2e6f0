"""Structured Streaming monitors.

* ``start_daily_drift``: categorical drift (Jensen-Shannon) of each day of an
  arriving table against a fixed reference. State is a table, not executor
  memory (``day_state.DayState``): every micro-batch writes its per-(day, column,
  value) partial counts (overwritten on retry, so a replayed batch is not counted
  twice), then recomputes drift only for the days it touched, reading just those
  days' folders, and overwrites those day partitions of the result table. Late
  rows for an old day simply update that day. Older batches are folded together,
  so the number of files does not grow with the number of batches.
* ``start_daily_numeric_drift``: Kolmogorov-Smirnov of each day's numbers against
  the reference, from counts between fixed cut points of the reference.
* ``start_scoring``: predictions for rows as they arrive, appended to a
  Parquet table with the model name and version (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.exprs import js_term, qcol, safe_div
from tidemark.operators import ml
from tidemark.operators.drift import DEFAULT_DRIFT_THRESHOLD, DEFAULT_JS_THRESHOLD
from tidemark.operators.reference_cuts import ReferenceCuts
from tidemark.streaming.day_state import DayState

DAILY_DRIFT_SCHEMA = ("day date, column string, js_divergence double, n_reference long, "
                      "n_current long, drift_detected boolean")


def _long_counts(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys..., column, value) with text values, NULLs dropped."""
    cast = df.select(*keys, *[qcol(c).cast("string").alias(c) for c in columns])
    long = cast.unpivot(keys, [qcol(c) for c in columns], "column", "value")
    return long.where(F.col("value").isNotNull())


def write_reference_counts(reference: DataFrame, columns: list[str], path: str) -> str:
    """(column, value, n_ref) for the reference, written once as a table."""
    long = _long_counts(reference, columns, [])
    long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_ref")) \
        .write.mode("overwrite").parquet(path)
    return path


def daily_js(spark: SparkSession, ref_counts_path: str, day_counts: DataFrame,
             js_threshold: float = DEFAULT_JS_THRESHOLD) -> DataFrame:
    """JS per (day, column) from current counts (day, column, value, n) and the
    reference count table; keys absent on one side count as 0."""
    # A value that a day lacks adds js_term(p, 0), whatever the day: per column
    # these terms are summed once over the whole reference, and a day takes back
    # those of the values it has. No reference row is copied per day.
    ref = spark.read.parquet(ref_counts_path)
    ref_tot = ref.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"))  # one row per column
    zero = F.lit(0.0)
    shares = ref.join(F.broadcast(ref_tot), "column").select("column", "value", safe_div(F.col("n_ref"), F.col("tot_ref")).alias("p"))
    absent = ref_tot.join(shares.groupBy("column").agg(F.sum(js_term(F.col("p"), zero)).alias("all_absent")), "column")
    cur_tot = day_counts.groupBy("day", "column").agg(F.sum("n").alias("tot_cur"))  # days x columns
    seen = day_counts.join(cur_tot, ["day", "column"]).join(shares, ["column", "value"], "left")
    term = js_term(F.col("p"), safe_div(F.col("n"), F.col("tot_cur")))
    taken = F.when(F.col("p").isNotNull(), js_term(F.col("p"), zero)).otherwise(zero)
    js = seen.groupBy("day", "column").agg(F.sum(term - taken).alias("part"), F.first("tot_cur").alias("n_current"))
    js = js.join(F.broadcast(absent), "column", "left").select(
        "day", "column", (F.col("part") + F.coalesce("all_absent", zero)).alias("js_divergence"),
        F.col("tot_ref").alias("n_reference"), "n_current")
    return js.select("day", "column", "js_divergence",
                     F.coalesce(F.col("n_reference"), F.lit(0)).cast("long").alias("n_reference"),
                     F.col("n_current").cast("long"),
                     (F.col("js_divergence") > F.lit(js_threshold)).alias("drift_detected"))


def start_daily_drift(stream: DataFrame, reference: DataFrame, columns: list[str], ts_col: str,
                      out_path: str, state_path: str, checkpoint_path: str,
                      js_threshold: float = DEFAULT_JS_THRESHOLD, trigger: dict | None = None,
                      fold_after: int = 16) -> StreamingQuery:
    """Start the daily drift monitor; returns the running query. Rows without a
    timestamp belong to no day and are left out."""
    spark = stream.sparkSession
    ref_path = write_reference_counts(reference, columns, f"{state_path}/reference_counts")
    state = DayState(spark, f"{state_path}/days", "column string, value string", fold_after=fold_after)

    def process(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(qcol(ts_col)).alias("day")
        long = _long_counts(batch.select(day, *[qcol(c) for c in columns]), columns, ["day"])
        partial = long.groupBy("day", "column", "value").agg(F.count(F.lit(1)).alias("n"))
        acc = state.add(batch_id, partial)
        daily_js(spark, ref_path, acc, js_threshold).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out_path)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def start_daily_numeric_drift(stream: DataFrame, reference: DataFrame, columns: list[str], ts_col: str,
                              out_path: str, state_path: str, checkpoint_path: str, pieces: int = 256,
                              p_threshold: float = DEFAULT_DRIFT_THRESHOLD, trigger: dict | None = None,
                              fold_after: int = 16) -> StreamingQuery:
    """Kolmogorov-Smirnov of each day's numbers against the reference, as rows
    arrive: (day, column, statistic, statistic_max, p_value, n_reference,
    n_current, drift_detected, decided).

    The state holds a day's counts at and between the reference's cut points
    (``reference_cuts``), at most 2 * ``pieces`` + 1 rows a day and column however
    many distinct values arrive. The true statistic lies between ``statistic`` and
    ``statistic_max``, which are at most 1 / ``pieces`` apart. Drift is reported
    when the lower bound's p-value is under ``p_threshold``; ``decided`` says that
    the upper bound gives the same verdict. Nulls and NaN are left out, as are
    rows without a timestamp; a column without reference values has no statistic."""
    cuts = ReferenceCuts.of(reference, columns, pieces)
    reference_places = f"{state_path}/reference_places"
    cuts.counts(reference, []).write.mode("overwrite").parquet(reference_places)
    spark = stream.sparkSession
    state = DayState(spark, f"{state_path}/days", "column string, place int", fold_after=fold_after)

    def process(batch: DataFrame, batch_id: int) -> None:
        counts = cuts.counts(batch.withColumn("day", F.to_date(qcol(ts_col))), ["day"])
        found = cuts.bounds(spark.read.parquet(reference_places), state.add(batch_id, counts), "day", p_threshold)
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out_path)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_scoring(trained: ml.TrainedModel, stream: DataFrame, out_path: str, checkpoint_path: str,
                  model_name: str, model_version: str | None = None, keep: list[str] | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Score rows on arrival; appends (keep..., prediction, probability,
    model_name, model_version, scored_at) to a Parquet table."""
    scored = ml.predict(trained, stream, keep=keep).withColumn("model_name", F.lit(model_name)) \
        .withColumn("model_version", F.lit(model_version).cast("string")) \
        .withColumn("scored_at", F.current_timestamp())
    writer = scored.writeStream.format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint_path).outputMode("append")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_daily_drift_windowed(stream: DataFrame, reference: DataFrame, columns: list[str], ts_col: str,
                               out_path: str, state_path: str, checkpoint_path: str,
                               watermark: str = "1 day", js_threshold: float = DEFAULT_JS_THRESHOLD,
                               trigger: dict | None = None, fold_after: int = 16) -> StreamingQuery:
    """Watermarked variant: per-(day, column, value) counts are kept in the
    streaming state of a ``window(ts, "1 day")`` aggregation, whose watermark
    drops days that no row can reach any more. Every micro-batch adds its changed
    counts to a table and rescores the days they belong to, so an open day (the
    last one included) has its score so far and none waits for a later row.

    ``watermark`` is the caller's promise: rows later than it, measured against
    the newest event of earlier micro-batches, are dropped. Choose it above the
    disorder of the source, or use ``start_daily_drift``, which accepts any.
    Days are UTC calendar days of the event time; a TIMESTAMP_NTZ column is read
    as UTC. The reference counts are written once as a table."""
    spark = stream.sparkSession
    ref_path = write_reference_counts(reference, columns, f"{state_path}/reference_counts")
    # counts only grow: the newest of a value is its largest
    state = DayState(spark, f"{state_path}/days", "column string, value string", F.max, fold_after)
    if isinstance(stream.schema[ts_col].dataType, T.TimestampNTZType):
        # Watermarks need an instant: read the wall clock as UTC, so days stay
        # the calendar days of the data whatever the session time zone.
        stream = stream.withColumn(ts_col, F.to_timestamp(
            F.concat(F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    long = _long_counts(stream.withWatermark(ts_col, watermark).select(ts_col, *columns), columns, [ts_col])
    counts = long.groupBy(F.window(ts_col, "1 day").alias("w"), "column", "value").agg(
        F.count(F.lit(1)).alias("n"))

    def process(batch: DataFrame, batch_id: int) -> None:
        # UTC day of the window start, independent of the session time zone.
        day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
        days = state.add(batch_id, batch.select(day.alias("day"), "column", "value", "n"))
        daily_js(spark, ref_path, days, js_threshold).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out_path)

    writer = counts.writeStream.outputMode("update").foreachBatch(process) \
        .option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
