"""Exact, reproducible three-way split (train / validation / test).

Rows are ordered by md5(seed | key) (the key should identify rows; ties are
broken by the key and a whole-row hash). The first ceil(n * test_size) rows are
held out; the first floor(holdout / 2) of those are validation, the rest
test. Sizes are exact and independent of partitioning.

No global sort: rows are counted per 16-bit hash bucket (65,536 buckets,
map-side partial counts); that bounded table gives every bucket's first rank,
so whole buckets are assigned by a CASE on the bucket id, and only the rows of
the (at most two) buckets that straddle a cut are ranked, inside their
bucket."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol
from tidemark.operators.ordered import positions

BUCKET_HEX_CHARS = 4  # 16^4 = 65,536 buckets: the bucket table stays small
BROADCAST_LABELS = 10_000  # labels with their counts that every task may hold; more are joined by a shuffle


def split_hash(key_cols: list[str], seed: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[qcol(c).cast("string") for c in key_cols]))


def split_sizes(n: int, test_size: float = 0.2) -> tuple[int, int, int]:
    """(train, validation, test) row counts for n rows."""
    hold = math.ceil(n * test_size) if isinstance(test_size, float) else int(test_size)
    test = math.ceil(hold * 0.5)
    return n - hold, hold - test, test


def _cut_bucket(order: list[int], starts: dict[int, int], counts: dict[int, int], cut: int):
    """(bucket holding global rank ``cut``, its start rank); past the end ->
    (a bucket id above every real one, n)."""
    for b in order:
        if starts[b] + counts[b] > cut:
            return b, starts[b]
    return 1 << (4 * BUCKET_HEX_CHARS), sum(counts.values())


def assign_split(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """Add ``split_col`` in {'train', 'validation', 'test'}."""
    h = split_hash(key_cols, seed)
    rows = df.withColumn("_h", h).withColumn(
        "_b", F.conv(F.substring("_h", 1, BUCKET_HEX_CHARS), 16, 10).cast("long"))
    # Bounded collect: at most 16^BUCKET_HEX_CHARS (bucket, count) pairs.
    counts = {r[0]: r[1] for r in rows.groupBy("_b").agg(F.count(F.lit(1))).collect()}
    order = sorted(counts)
    starts, acc = {}, 0
    for b in order:
        starts[b] = acc
        acc += counts[b]
    _, n_val, n_test = split_sizes(acc, test_size)
    cut1, cut2 = n_val, n_val + n_test
    (b1, s1), (b2, s2) = (_cut_bucket(order, starts, counts, c) for c in (cut1, cut2))
    edges = {b: s for b, s, c in ((b1, s1, cut1), (b2, s2, cut2)) if s < c}
    bucket = F.col("_b")
    whole = F.when(bucket < b1, "validation").when(bucket < b2, "test").otherwise("train")
    keep = [qcol(c) for c in [*df.columns, split_col]]
    if not edges:
        return rows.withColumn(split_col, whole).select(*keep)
    is_edge = bucket.isin(list(edges))
    pure = rows.where(~is_edge).withColumn(split_col, whole)
    start = F.lit(0).cast("long")
    # Order inside a boundary bucket: hash, key, then a whole-row hash, so rows
    # sharing a key keep one order on every recomputation (rows equal in every
    # column are interchangeable). The rows of the at most two buckets are
    # ranked by the salted distributed sort, since a key repeated over a huge
    # share of rows lands in one bucket.
    hashable = [qcol(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    edge = rows.where(is_edge).withColumn("_t", F.xxhash64(*hashable) if hashable else F.lit(0))
    edge = positions(edge, ["_b", "_h", *[qcol(c) for c in key_cols], "_t"], "_p")
    passed = 0
    for b in sorted(edges):  # from a place among the edge rows to a rank among all
        start = F.when(bucket == b, F.lit(edges[b] - passed)).otherwise(start)
        passed += counts[b]
    edge = edge.withColumn("_r", start + F.col("_p"))
    edge = edge.withColumn(split_col, F.when(F.col("_r") < cut1, "validation")
                           .when(F.col("_r") < cut2, "test").otherwise("train"))
    return pure.select(*keep).unionByName(edge.select(*keep))


def three_way_split(df: DataFrame, key_cols: list[str], test_size: float = 0.2,
                    seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test) DataFrames."""
    tagged = assign_split(df, key_cols, test_size, seed)
    parts = [tagged.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]
    return parts[0], parts[1], parts[2]


def _ranked(df: DataFrame, label_col: str, key_cols: list[str], seed: int) -> DataFrame:
    """``df`` with ``_rank``, the row's rank within its label in md5(seed | key)
    order, and ``_n``, the label's rows (a null label is a label).

    Ranks come from one salted distributed sort over (label, hash)
    (``ordered.positions``): a label with a third of all rows, or a key repeated
    over a huge share of them, is spread over many range partitions."""
    hashable = [qcol(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = df.withColumn("_h", split_hash(key_cols, seed)).withColumn("_t", F.xxhash64(*hashable) if hashable else F.lit(0))
    placed = positions(rows, [qcol(label_col), "_h", *[qcol(c) for c in key_cols], "_t"], "_p")
    labels = placed.groupBy(qcol(label_col).alias("_lab")).agg(F.min("_p").alias("_p0"), F.count(F.lit(1)).alias("_n"))
    # a shuffle by a label of a few values would leave as many partitions as there are values
    labels = labels.checkpoint(eager=True)
    if labels.count() <= BROADCAST_LABELS:
        labels = F.broadcast(labels)
    joined = placed.join(labels, qcol(label_col).eqNullSafe(F.col("_lab")))
    return joined.withColumn("_rank", F.col("_p") - F.col("_p0"))


def assign_folds(df: DataFrame, label_col: str, key_cols: list[str], k: int = 5, seed: int = 42,
                 fold_col: str = "fold") -> DataFrame:
    """Stratified k-fold: ``fold_col`` = (rank of the row within its label,
    in md5(seed | key) order) mod k, so every label's rows are spread over the
    folds with sizes differing by at most one."""
    fold = (F.col("_rank") % F.lit(k)).cast("long")
    return _ranked(df, label_col, key_cols, seed).select(*[qcol(c) for c in df.columns], fold.alias(fold_col))


def assign_stratified_split(df: DataFrame, label_col: str, key_cols: list[str], test_size: float = 0.2,
                            seed: int = 42, split_col: str = "split") -> DataFrame:
    """Add ``split_col`` in {'train', 'validation', 'test'} with the sizes of
    ``split_sizes`` in every label by itself, so that each part has the labels'
    shares. A label with one row is held out whole (as a table with one row is)."""
    if not 0.0 <= test_size <= 1.0:
        raise ValueError(f"test_size {test_size!r} is not a share of the rows")
    hold = F.ceil(F.col("_n") * F.lit(float(test_size)))
    validation = hold - F.ceil(hold * 0.5)
    part = F.when(F.col("_rank") < validation, "validation").when(F.col("_rank") < hold, "test").otherwise("train")
    return _ranked(df, label_col, key_cols, seed).select(*[qcol(c) for c in df.columns], part.alias(split_col))
