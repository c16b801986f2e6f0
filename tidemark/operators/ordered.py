"""Order statistics without a single-task window.

A window ``partitionBy(column).orderBy(value)`` puts every distinct value of a
column into one task. Running sums are taken in two levels here, all of it with
built-in expressions: the (column, value) table is range-partitioned, a row's
range becomes its ``bucket`` column, a window runs inside each bucket, and one
summary row a bucket carries the bucket's sums and least value. A small window
over the summaries (bounded by partitions x columns) gives every bucket's
offset. The inputs are counts, one row a distinct value, so a value that holds a
third of all rows is one row and a column with many values spreads over buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import qcol
from tidemark.session import ensure_checkpoint_dir


def _bucketed(df: DataFrame) -> DataFrame:
    """``df`` in ranges of (column, value) with the range's number as ``bucket``.
    A number names a range of this very shuffle: use it once, or checkpoint
    the table before using it twice."""
    return df.repartitionByRange("column", "value").withColumn("bucket", F.spark_partition_id())


def _in_bucket():
    return Window.partitionBy("column", "bucket").orderBy("value")


def _up_to(column: str, end: int = Window.currentRow):
    """Sum of ``column`` over the bucket's values up to this one (``end`` -1: below it)."""
    return F.sum(column).over(_in_bucket().rowsBetween(Window.unboundedPreceding, end))


def _with_offsets(buckets: DataFrame, *sum_cols: str) -> DataFrame:
    """Add off_<c> = sum of <c> over the earlier buckets of the same column. The
    window sees one row a bucket, never the rows themselves."""
    w = Window.partitionBy("column").orderBy("first_value").rowsBetween(Window.unboundedPreceding, -1)
    for c in sum_cols:
        buckets = buckets.withColumn(f"off_{c}", F.coalesce(F.sum(c).over(w), F.lit(0)))
    return buckets


def _gap(ref, cur):
    """Share of the reference up to here less share of the current side; 0 for an empty side."""
    return (F.coalesce(F.try_divide(ref.cast("double"), F.col("tot_ref")), F.lit(0.0))
            - F.coalesce(F.try_divide(cur.cast("double"), F.col("tot_cur")), F.lit(0.0)))


def ks_statistics(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Two-sample KS statistic per column.

    ``counts``: (column string, value double, n_ref long, n_cur long), one row
    per distinct non-null value; ``totals``: (column, tot_ref, tot_cur), one
    row per column (broadcast). Returns (column, statistic, tot_ref, tot_cur) with
    D = max_x |F_ref(x) - F_cur(x)|. A bucket's offset moves all its gaps alike,
    so the places of its largest and smallest gap are kept and nothing is joined
    back to the values."""
    rows = _bucketed(counts).select("*", _up_to("n_ref").alias("up_ref"), _up_to("n_cur").alias("up_cur"))
    gap, place = _gap(F.col("up_ref"), F.col("up_cur")), F.struct("up_ref", "up_cur")
    buckets = rows.join(F.broadcast(totals), "column").groupBy("column", "bucket").agg(
        F.min("value").alias("first_value"), F.sum("n_ref").alias("sum_ref"), F.sum("n_cur").alias("sum_cur"),
        F.max_by(place, gap).alias("high"), F.min_by(place, gap).alias("low"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"))

    def distance(at):
        return F.abs(F.try_divide((F.col("off_sum_ref") + F.col(f"{at}.up_ref")).cast("double"), F.col("tot_ref"))
                     - F.try_divide((F.col("off_sum_cur") + F.col(f"{at}.up_cur")).cast("double"), F.col("tot_cur")))

    return _with_offsets(buckets, "sum_ref", "sum_cur").groupBy("column").agg(
        F.max(F.greatest(distance("high"), distance("low"))).alias("statistic"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"))


def rank_auc(counts: DataFrame) -> DataFrame:
    """Exact ROC AUC per column by the rank-sum formula (ties count half).

    ``counts``: (column string, value double, n_pos long, n_neg long), one row
    per distinct score. AUC = sum_s pos_s (negatives below s + neg_s / 2) /
    (P * N); the term is linear in a bucket's negative offset, so one sum a
    bucket and the offsets give it exactly."""
    below = F.coalesce(_up_to("n_neg", -1), F.lit(0))
    rows = _bucketed(counts).withColumn("local", F.col("n_pos") * (below + 0.5 * F.col("n_neg")))
    buckets = rows.groupBy("column", "bucket").agg(
        F.min("value").alias("first_value"), F.sum("n_pos").alias("sum_pos"), F.sum("n_neg").alias("sum_neg"), F.sum("local").alias("local"))
    return _with_offsets(buckets, "sum_neg").groupBy("column").agg(
        F.try_divide(F.sum(F.col("off_sum_neg").cast("double") * F.col("sum_pos") + F.col("local")),
                     F.sum("sum_pos").cast("double") * F.sum("sum_neg").cast("double")).alias("auc"),
        F.sum("sum_pos").alias("n_pos"), F.sum("sum_neg").alias("n_neg"))


def wasserstein_distances(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """First Wasserstein distance per column between the reference and current
    empirical distributions: integral of |F_ref - F_cur| over the value axis.

    ``counts`` and ``totals`` as for ``ks_statistics``. The absolute value
    makes a value's part depend on its bucket's offset, so the bucketed table is
    checkpointed to the shared folder, which fixes the bucket numbers, and the
    offsets are joined back by bucket. A bucket's last value reaches to the
    first value of the next."""
    ensure_checkpoint_dir(counts.sparkSession)
    rows = _bucketed(counts).checkpoint(eager=True)
    buckets = _with_offsets(rows.groupBy("column", "bucket").agg(
        F.min("value").alias("first_value"), F.sum("n_ref").alias("sum_ref"), F.sum("n_cur").alias("sum_cur")), "sum_ref", "sum_cur")
    behind = F.lead("first_value").over(Window.partitionBy("column").orderBy("first_value"))
    buckets = buckets.select("column", "bucket", "off_sum_ref", "off_sum_cur", behind.alias("next_first")).join(F.broadcast(totals), "column")
    rows = rows.select("column", "bucket", "value", _up_to("n_ref").alias("up_ref"), _up_to("n_cur").alias("up_cur"),
                       F.lead("value").over(_in_bucket()).alias("next_value"))
    width = F.coalesce(F.col("next_value"), F.col("next_first")) - F.col("value")
    part = F.abs(_gap(F.col("off_sum_ref") + F.col("up_ref"), F.col("off_sum_cur") + F.col("up_cur"))) * width
    return rows.join(buckets, ["column", "bucket"]).groupBy("column").agg(F.coalesce(F.sum(part), F.lit(0.0)).alias("wasserstein"))


def quantile_cuts(counts: DataFrame, pieces: int) -> DataFrame:
    """(column, value): the values whose rows reach or cross a multiple of a
    ``pieces``-th of their column's rows, so that less than a ``pieces``-th lies
    strictly between two neighbours. At most ``pieces`` rows a column.

    ``counts``: (column string, value double, n long), one row per distinct
    value. The bucketed table is checkpointed, which fixes the bucket numbers, and
    the offsets are joined back by bucket."""
    ensure_checkpoint_dir(counts.sparkSession)
    rows = _bucketed(counts).checkpoint(eager=True)
    buckets = _with_offsets(rows.groupBy("column", "bucket").agg(F.min("value").alias("first_value"), F.sum("n").alias("sum_n")), "sum_n")
    buckets = buckets.select("column", "bucket", "off_sum_n", F.sum("sum_n").over(Window.partitionBy("column")).alias("total"))
    placed = rows.withColumn("up", _up_to("n")).join(buckets, ["column", "bucket"]).withColumn("up", F.col("up") + F.col("off_sum_n"))
    reached, before = (f"CAST({x} AS DECIMAL(38, 0)) * {int(pieces)} div total" for x in ("up", "(up - n)"))
    return placed.where(f"{reached} > {before}").select("column", "value")


def exact_medians(long_values: DataFrame) -> dict[str, float | None]:
    """Exact median per column (mean of the two middle values for an even
    count), as pandas computes it, without holding a column in one task.

    ``long_values``: (column string, value double), NULLs allowed. Two small
    collects: the bucket (run of values) containing each middle rank, then the
    value itself."""
    counts = (long_values.where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    runs = _bucketed(counts).groupBy("column", "bucket").agg(
        F.min("value").alias("first_value"), F.max("value").alias("last_value"), F.sum("n").alias("cnt"))
    runs = _with_offsets(runs, "cnt")
    tot = Window.partitionBy("column")
    runs = runs.withColumn("total", F.sum("cnt").over(tot))
    targets = []
    for r in runs.collect():  # bounded: one row per run (partitions x columns)
        n = r["total"]
        for k in {(n - 1) // 2, n // 2}:
            if r["off_cnt"] <= k < r["off_cnt"] + r["cnt"]:
                targets.append((r["column"], r["first_value"], r["last_value"], r["off_cnt"], k))
    if not targets:
        return {}
    spark = long_values.sparkSession
    tdf = spark.createDataFrame(targets, "column string, lo double, hi double, start long, k long")
    # only the values of those runs are counted again (two small rows a column are joined)
    inside = long_values.join(F.broadcast(tdf), "column").where(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    inside = inside.groupBy("column", "lo", "hi", "start", "k", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column", "k").orderBy("value")  # one run per task
    inside = inside.withColumn("cum", F.col("start") + F.sum("n").over(w))
    picked = (inside.where(F.col("cum") > F.col("k"))
              .groupBy("column", "k").agg(F.min("value").alias("v")))
    found: dict[str, list[float]] = {}
    for r in picked.collect():  # at most two rows per column
        found.setdefault(r["column"], []).append(r["v"])
    return {c: (sum(v) / len(v) if len(v) == 1 else (v[0] + v[1]) / 2.0) for c, v in found.items()}


def positions(df: DataFrame, order_cols: list, pos_col: str = "_pos") -> DataFrame:
    """``df`` plus the exact 0-based position of every row in ``order_cols``
    order, with no single-task sort even when one key value repeats over a
    large share of rows.

    A random salt is the last sort key, so equal keys spread over several
    range partitions; the sorted partitions are checkpointed to the shared
    folder, which fixes each row's partition and place (rows with equal keys
    are interchangeable, so the salt only decides which copy comes first).
    A position is its partition's offset (one count per partition) plus its
    place in the partition, read from ``monotonically_increasing_id``."""
    ensure_checkpoint_dir(df.sparkSession)
    salted = df.withColumn("_salt", F.rand())
    keys = [*order_cols, "_salt"]
    ordered = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    with_id = ordered.withColumn("_mid", F.monotonically_increasing_id())
    with_id = with_id.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_in", F.col("_mid").bitwiseAND((1 << 33) - 1))
    sizes = with_id.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))  # one row per partition
    out = with_id.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return out.withColumn(pos_col, F.col("_off") + F.col("_in")).drop("_salt", "_mid", "_pid", "_in", "_off")


def dense_codes(values: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """(value, code): codes 0..k-1 in ascending order of the distinct non-null
    values of ``col`` (a global dense rank).

    The distinct values are range-partitioned, sorted and checkpointed to the
    shared checkpoint folder, which fixes partition contents; each row's code is
    its partition's offset plus its position, read from
    ``monotonically_increasing_id``. Offsets come from one count per partition."""
    ensure_checkpoint_dir(values.sparkSession)
    distinct = values.select(qcol(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    ordered = distinct.repartitionByRange("value").sortWithinPartitions("value").checkpoint(eager=True)
    with_id = ordered.withColumn("_mid", F.monotonically_increasing_id())
    with_id = with_id.select("value", F.shiftright("_mid", 33).alias("_pid"),
                             F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_pos"))
    sizes = with_id.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))  # one row per partition
    return (with_id.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .select("value", (F.col("_off") + F.col("_pos")).alias(code_col)))
