import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, perf, split


@pytest.mark.parametrize("n", [1, 7, 10, 101, 2000])
def test_split_sizes_exact_and_disjoint(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    tagged = split.assign_split(df, ["k"], 0.2, 42)
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    tr, va, te = split.split_sizes(n, 0.2)
    assert counts.get("train", 0) == tr and counts.get("validation", 0) == va and counts.get("test", 0) == te
    assert tagged.select("k").distinct().count() == n


def test_split_independent_of_partitioning(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    a = {(r["k"], r["split"]) for r in split.assign_split(df, ["k"]).collect()}
    b = {(r["k"], r["split"]) for r in split.assign_split(df.repartition(11), ["k"]).collect()}
    assert a == b


def test_classification_metrics_by_hand(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (2, 2)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = metrics.as_dict(metrics.classification_metrics(df, metrics=["accuracy", "precision", "recall", "f1"]))
    # per class precision: 0 -> 1/1, 1 -> 2/4, 2 -> 1/1 ; recall: 1/2, 2/2, 1/2 ; support 2,2,2
    assert m["accuracy"] == pytest.approx(4 / 6)
    assert m["precision"] == pytest.approx((1 + 0.5 + 1) / 3)
    assert m["recall"] == pytest.approx(4 / 6)
    f1 = [2 * 1 * .5 / 1.5, 2 * .5 * 1 / 1.5, 2 * 1 * .5 / 1.5]
    assert m["f1"] == pytest.approx(sum(f1) / 3)


def test_regression_metrics_and_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    m = metrics.as_dict(metrics.regression_metrics(df, metrics=["mse", "rmse", "mae", "r2"]))
    assert m["mse"] == pytest.approx((0.25 + 0 + 1) / 3)
    assert m["rmse"] == pytest.approx(math.sqrt((0.25 + 1) / 3))
    assert m["r2"] == pytest.approx(1 - 1.25 / 2.0)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    assert metrics.as_dict(metrics.regression_metrics(const, metrics=["r2"]))["r2"] == 1.0


def test_degradation_rules(spark):
    base = spark.createDataFrame([("acc", 0.9), ("loss", 0.5), ("zero", 0.0), ("zero2", 0.0)], "metric string, value double")
    cur = spark.createDataFrame([("acc", 0.7), ("loss", 0.6), ("zero", 0.0), ("zero2", 1.0), ("new", 3.0)],
                                "metric string, value double")
    cfg = {"lower_is_better_metrics": ["loss", "zero2"]}
    ch = {r["metric"]: r for r in perf.metric_changes(cur, base, cfg).collect()}
    assert set(ch) == {"acc", "loss", "zero", "zero2"}
    assert ch["acc"]["degraded"] and ch["loss"]["degraded"]
    assert ch["zero"]["relative_change"] == 0.0 and not ch["zero"]["degraded"]
    assert math.isinf(ch["zero2"]["relative_change"]) and ch["zero2"]["degraded"]
    s = perf.degradation_summary(cur, base, cfg).first()
    assert s["degraded_metrics"] == 3 and s["total_metrics"] == 5
    assert s["degradation_score"] == pytest.approx(0.6) and s["performance_degradation_detected"]
    empty = spark.createDataFrame([], "metric string, value double")
    s0 = perf.degradation_summary(empty, base, cfg).first()
    assert s0["degradation_score"] is None and not s0["performance_degradation_detected"]


def test_roc_auc_matches_bruteforce_with_ties(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = metrics.roc_auc(df).first()["auc"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(brute, abs=1e-12)


def test_missing_share_and_outliers(spark):
    from tidemark.operators import quality
    df = spark.createDataFrame([(1.0, None)] * 9 + [(100.0, "x")], "v double, s string")
    ms = {r["column"]: r for r in quality.missing_share(df, 0.5).collect()}
    assert ms["s"]["missing_share"] == pytest.approx(0.9) and ms["s"]["above_threshold"]
    assert ms["v"]["null_count"] == 0 and not ms["v"]["above_threshold"]
    oc = {r["column"]: r["n_outliers"] for r in quality.outlier_counts(df, ["v"], 2.0).collect()}
    assert oc == {"v": 1}


def test_kfold_stratified_balanced(spark):
    df = spark.range(1000).select(F.col("id").alias("k"),
                                  F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b")
                                  .otherwise(None).alias("y"))
    out = split.assign_folds(df, "y", ["k"], k=4)
    assert out.count() == 1000
    sizes = {}
    for r in out.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    for label, s in sizes.items():
        assert len(s) == 4 and max(s) - min(s) <= 1, (label, s)


def test_hot_key_paths_match_window_paths(spark):
    # one key value repeated over a third of the rows; force the distributed ranking
    base = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("payload"),
                                    (F.col("id") % 2).alias("y"))
    want_sizes = split.split_sizes(3000, 0.2)
    tagged = split.assign_split(base, ["k"], 0.2, 42)
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert (counts["train"], counts["validation"], counts["test"]) == want_sizes
    assert tagged.select("payload").distinct().count() == 3000
    folds = split.assign_folds(base, "y", ["k"], k=4)
    sizes = {}
    for r in folds.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    assert all(len(v) == 4 and max(v) - min(v) <= 1 for v in sizes.values())
    assert folds.count() == 3000


def test_positions_exact_with_repeated_keys(spark):
    from tidemark.operators.ordered import positions
    df = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit(5)).otherwise(F.col("id")).alias("k"),
                                  F.col("id"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = positions(df, ["k"], "p").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(r["p"] for r in rows) == list(range(2000))
    by_pos = sorted(rows, key=lambda r: r["p"])
    assert [r["k"] for r in by_pos] == sorted(r["k"] for r in rows)


def test_split_hot_bucket_on_cut(spark):
    # every row shares the key, so the single bucket straddles both cuts
    df = spark.range(500).select(F.lit(1).alias("k"), F.col("id").alias("payload"))
    tagged = split.assign_split(df, ["k"], 0.2, 42)
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert (counts["train"], counts["validation"], counts["test"]) == split.split_sizes(500, 0.2)
    assert tagged.select("payload").distinct().count() == 500


def test_metrics_of_mixed_types(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 1.0)], "label long, prediction double")
    assert metrics.as_dict(metrics.classification_metrics(df, metrics=["accuracy", "precision", "recall", "f1"])) == {
        "accuracy": 1.0, "precision": 1.0, "recall": 1.0, "f1": 1.0}


def test_auc_of_huge_counts(spark):
    from tidemark.operators.ordered import rank_auc
    big = 4 * 10**9
    counts = spark.createDataFrame([("s", 0.1, 0, big), ("s", 0.9, big, 0)], "column string, value double, n_pos long, n_neg long")
    assert abs(rank_auc(counts).first()["auc"] - 1.0) < 1e-12
