"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """At most ``rows`` texts in an Arrow batch while a table is written: ten
    thousand, the usual number, take tens of megabytes several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses do
    not recompute it, and a lost executor costs nothing that came before.
    Grouped tables that are joined back to their rows are cut, too: only a join
    whose sides come straight from a shuffle can have its skewed partitions
    split at run time."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Slices of a record batch whose text is at most ``max_bytes`` long (one
    row at least), so scratch memory does not follow the batch size."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers live on for the next task


def _fingerprint(e: DataFrame):
    return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Connected components of an undirected edge list of longs.

    Alternates the large-star and small-star steps (Kiveris et al. 2014): every
    step only regroups edges by a node, so no group is gathered and a node with
    a third of all edges is pre-aggregated by ``min``. Returns (node,
    component_id) with the smallest node of each component; nodes without an
    edge do not appear. An empty edge list gives an empty table.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct()
    e = cut(e, "edges")
    state = _fingerprint(e)
    while True:
        # large star: every larger neighbour of a node points at the node's smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "edges")
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour, and the node itself, points at the smallest
        e = cut(e, "edges")
        e = e.join(cut(e.groupBy("u").agg(F.min("v").alias("m")), "edges"), "u")
        e = e.select(F.col("v").alias("u"), F.col("m").alias("v")).union(e.select("u", F.col("m").alias("v")))
        e = cut(e.where("u <> v").distinct(), "edges")
        before, state = state, _fingerprint(e)
        if state == before:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct())
