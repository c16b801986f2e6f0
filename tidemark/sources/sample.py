"""Synthetic sample table: id, two standard-normal features, a category in
A/B/C and a binary target, generated on the executors from a seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sample table's categories.
SAMPLE_CATEGORIES = ["A", "B", "C"]


def _uniform(seed: int, use: int) -> Column:
    """Uniform in (0, 1) from a hash of the row's id: the same on every cluster."""
    return (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(use)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _normal(seed: int, use: int) -> Column:
    """Standard normal from two uniforms (Box-Muller)."""
    return F.sqrt(-2.0 * F.ln(_uniform(seed, use))) * F.cos(2.0 * math.pi * _uniform(seed, use + 1))


def sample_table(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    """(id long, feature1 double, feature2 double, category string, target long).
    Deterministic for a seed, whatever the partitioning; not bit-equal to numpy."""
    cats = F.array(*[F.lit(c) for c in SAMPLE_CATEGORIES])
    return spark.range(n).select(
        F.col("id"),
        _normal(seed, 0).alias("feature1"),
        _normal(seed, 2).alias("feature2"),
        F.element_at(cats, (F.floor(_uniform(seed, 4) * len(SAMPLE_CATEGORIES)) + 1).cast("int")).alias("category"),
        F.floor(_uniform(seed, 5) * 2).cast("long").alias("target"),
    )
