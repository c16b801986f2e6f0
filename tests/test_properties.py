"""Property tests from the test strategy: fit/transform equality, scaling
moments, self-drift, and randomized KS / split checks against brute force."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import drift, prep, split

CHAIN = [{"type": "fill_missing", "columns": ["v"], "method": "median"},
         {"type": "encode_categorical", "columns": ["c"], "method": "label"},
         {"type": "scale_numerical", "columns": ["v", "w"]}]


def _table(spark):
    return spark.range(300).select(
        F.col("id"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 7 % 23).cast("double")).alias("v"),
        (F.col("id") % 11).cast("double").alias("w"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("c"))


def test_fit_transform_equals_transform_with_fitted(spark):
    df = _table(spark)
    once, fitted = prep.fit_transform(df, CHAIN)
    again = prep.transform(df, fitted)
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in again.collect())
    assert a == b


def test_scaled_columns_have_zero_mean_unit_std(spark):
    out, _ = prep.fit_transform(_table(spark), [{"type": "scale_numerical", "columns": ["v", "w"]}])
    r = out.agg(F.avg("v"), F.stddev_samp("v"), F.avg("w"), F.stddev_samp("w")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9 and abs(r[2]) < 1e-9 and abs(r[3] - 1) < 1e-9


def test_table_against_itself_does_not_drift(spark):
    df = _table(spark)
    res = drift.detect_drift(df, df, {"categorical_columns": ["c"]})
    for r in res.columns.collect():
        if r["kind"] == "numeric":
            assert r["statistic"] == 0.0 and r["p_value"] == 1.0
        else:
            assert abs(r["js_divergence"]) < 1e-12
        assert not r["drift_detected"]
    assert res.summary.first()["columns_drifted"] == 0


small_lists = st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(xs=small_lists, ys=small_lists)
def test_ks_random_against_bruteforce(spark, xs, ys):
    ref = spark.createDataFrame([(float(x),) for x in xs], "v double")
    cur = spark.createDataFrame([(float(y),) for y in ys], "v double")
    d = drift.numeric_drift(ref, cur, ["v"]).first()["statistic"]
    pts = sorted(set(xs + ys))
    brute = max(abs(sum(x <= p for x in xs) / len(xs) - sum(y <= p for y in ys) / len(ys)) for p in pts)
    assert abs(d - brute) < 1e-12


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(min_value=1, max_value=400), seed=st.integers(min_value=0, max_value=10_000),
       test_size=st.sampled_from([0.1, 0.2, 0.25, 0.5]))
def test_split_random_sizes(spark, n, seed, test_size):
    df = spark.range(n).withColumnRenamed("id", "k")
    counts = {r["split"]: r["count"] for r in split.assign_split(df, ["k"], test_size, seed)
              .groupBy("split").count().collect()}
    tr, va, te = split.split_sizes(n, test_size)
    assert (counts.get("train", 0), counts.get("validation", 0), counts.get("test", 0)) == (tr, va, te)
    assert tr == n - math.ceil(n * test_size)
