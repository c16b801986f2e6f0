"""Two-level prefix sums against numpy, and their plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.metrics import roc_auc


def sides(seed, n=4000):
    """Two columns; in the first a third of all rows hold one value."""
    rng = random.Random(seed)
    rows = []
    for side in (0, 1):
        for _ in range(n):
            rows.append(("hot", 5.0 if rng.random() < 1 / 3 else round(rng.gauss(side * 0.3, 2), 2), side))
        for _ in range(n // 4):
            rows.append(("flat", float(rng.randint(-3, 3 + side)), side))
    return rows


def counted(spark, rows):
    df = spark.createDataFrame(rows, "column string, value double, side int")
    counts = df.groupBy("column", "value").agg(F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))
    totals = df.groupBy("column").agg(F.count_if(F.col("side") == 0).alias("tot_ref"), F.count_if(F.col("side") == 1).alias("tot_cur"))
    return counts, totals


@pytest.fixture
def buckets(spark):
    """Ranges are kept apart, as they are on tables large enough."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_distances_against_numpy(spark, buckets):
    rows = sides(1)
    counts, totals = counted(spark, rows)
    ks = {r["column"]: r for r in ordered.ks_statistics(counts, totals).collect()}
    ws = {r["column"]: r["wasserstein"] for r in ordered.wasserstein_distances(counts, totals).collect()}
    for column in ("hot", "flat"):
        a, b = (np.sort([v for c, v, s in rows if c == column and s == side]) for side in (0, 1))
        x = np.unique(np.concatenate([a, b]))
        gap = np.searchsorted(a, x, "right") / len(a) - np.searchsorted(b, x, "right") / len(b)
        assert ks[column]["statistic"] == pytest.approx(np.abs(gap).max(), abs=1e-12)
        assert (ks[column]["tot_ref"], ks[column]["tot_cur"]) == (len(a), len(b))
        assert ws[column] == pytest.approx(float(np.sum(np.abs(gap[:-1]) * np.diff(x))), rel=1e-9)


def test_medians_against_numpy(spark, buckets):
    rows = sides(2)
    df = spark.createDataFrame([(c, v) for c, v, _ in rows] + [("hot", None), ("none", None)], "column string, value double")
    got = ordered.exact_medians(df)
    assert got == {c: float(np.median([v for k, v, _ in rows if k == c])) for c in ("hot", "flat")}


def test_auc_against_all_pairs(spark, buckets):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.choice([0.5, round(rng.random(), 2)])) for _ in range(600)]
    got = roc_auc(spark.createDataFrame(rows, "label int, score double")).first()
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got["auc"] == pytest.approx(want, abs=1e-12) and (got["n_pos"], got["n_neg"]) == (len(pos), len(neg))


def test_one_side_empty_and_no_rows(spark):
    counts, totals = counted(spark, [("a", 1.0, 0), ("a", 2.0, 0)])
    assert ordered.wasserstein_distances(counts.where("false"), totals).collect() == []
    assert ordered.ks_statistics(counts.where("false"), totals).collect() == []
    assert ordered.exact_medians(counts.select("column", "value").where("false")) == {}
    row = ordered.wasserstein_distances(counts, totals).first()
    assert row["wasserstein"] == pytest.approx(0.5)  # the empty side counts as a share of 0


def test_plans_hold_no_python_and_a_column_spreads(spark, buckets):
    counts, totals = counted(spark, sides(4))
    for df in (ordered.ks_statistics(counts, totals), ordered.rank_auc(counts.withColumnsRenamed({"n_ref": "n_pos", "n_cur": "n_neg"})),
               ordered.wasserstein_distances(counts, totals)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "Python", "ArrowEval"))
    sizes = [r["n"] for r in ordered._bucketed(counts.where("column = 'hot'")).groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)
