import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_js_identical_is_zero_and_symmetric(spark):
    a = _df(spark, [("x",), ("y",), ("y",), ("z",)], "c string")
    b = _df(spark, [("y",), ("z",), ("z",), ("q",)], "c string")
    same = drift.categorical_drift(a, a, ["c"]).first()
    assert abs(same["js_divergence"]) < 1e-12 and not same["drift_detected"]
    ab = drift.categorical_drift(a, b, ["c"]).first()["js_divergence"]
    ba = drift.categorical_drift(b, a, ["c"]).first()["js_divergence"]
    assert abs(ab - ba) < 1e-12
    assert 0 < ab <= math.log(2) + 1e-9


def test_js_disjoint_is_ln2(spark):
    a = _df(spark, [("x",)] * 5, "c string")
    b = _df(spark, [("y",)] * 5, "c string")
    js = drift.categorical_drift(a, b, ["c"]).first()["js_divergence"]
    assert abs(js - math.log(2)) < 1e-6


def test_all_null_categorical_is_zero(spark):
    a = _df(spark, [(None,), (None,)], "c string")
    r = drift.categorical_drift(a, a, ["c"]).first()
    assert r["js_divergence"] == 0.0 and not r["drift_detected"]


def test_ks_matches_bruteforce_and_monotone_invariance(spark):
    import random
    rnd = random.Random(7)
    xs = [rnd.gauss(0, 1) for _ in range(300)]
    ys = [rnd.gauss(0.3, 1.2) for _ in range(250)]
    ref = _df(spark, [(x,) for x in xs], "v double")
    cur = _df(spark, [(y,) for y in ys], "v double")
    d = drift.numeric_drift(ref, cur, ["v"]).first()["statistic"]
    pts = sorted(set(xs + ys))
    brute = max(abs(sum(x <= p for x in xs) / len(xs) - sum(y <= p for y in ys) / len(ys)) for p in pts)
    assert abs(d - brute) < 1e-12
    d2 = drift.numeric_drift(ref.select(F.exp("v").alias("v")), cur.select(F.exp("v").alias("v")),
                             ["v"]).first()["statistic"]
    assert abs(d - d2) < 1e-12


def test_ks_many_partitions_same_answer(spark):
    ref = spark.range(5000).select((F.col("id") % 997).cast("double").alias("v"))
    cur = spark.range(4000).select(((F.col("id") * 7) % 1013).cast("double").alias("v"))
    d1 = drift.numeric_drift(ref, cur, ["v"]).first()["statistic"]
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        d2 = drift.numeric_drift(ref.repartition(13), cur.repartition(3), ["v"]).first()["statistic"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert abs(d1 - d2) < 1e-12


def test_empty_side_not_drifted(spark):
    ref = _df(spark, [(1.0,), (2.0,)], "v double")
    cur = _df(spark, [(None,)], "v double")
    r = drift.numeric_drift(ref, cur, ["v"]).first()
    assert r["statistic"] is None and r["p_value"] is None
    assert not r["drift_detected"] and r["error"] == drift.INSUFFICIENT_DATA


def test_detect_drift_routing_and_summary(spark):
    ref = _df(spark, [("a", 1.0, "2024-01-01", 1), ("b", 2.0, "2024-01-02", 2)] * 50,
              "cat string, num double, ts string, only_ref int")
    cur = _df(spark, [("a", 10.0, "2024-02-01"), ("a", 11.0, "2024-02-02")] * 50,
              "cat string, num double, ts string")
    res = drift.detect_drift(ref, cur, {"datetime_column": "ts"})
    rows = {r["column"]: r for r in res.columns.collect()}
    assert set(rows) == {"cat", "num"}
    assert rows["cat"]["kind"] == "categorical" and rows["num"]["kind"] == "numeric"
    s = res.summary.first()
    assert s["total_columns"] == 3 and s["tested_columns"] == 2
    assert s["columns_drifted"] == 2 and s["data_drift_detected"]
    mm = {(r["column"], r["side"]) for r in res.mismatch.collect()}
    assert mm == {("only_ref", "missing_in_current")}


def test_monitor_requires_reference(spark):
    m = drift.DataDriftMonitor(spark, {})
    with pytest.raises(ValueError):
        m.detect_drift(_df(spark, [(1,)], "a int"))


def test_wasserstein_matches_bruteforce(spark):
    import random
    rnd = random.Random(11)
    xs = [round(rnd.gauss(0, 1), 2) for _ in range(500)]
    ys = [round(rnd.gauss(0.5, 1), 2) for _ in range(300)]
    ref = _df(spark, [(x,) for x in xs], "v double")
    cur = _df(spark, [(y,) for y in ys], "v double")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        r = drift.wasserstein_drift(ref, cur, ["v"]).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    pts = sorted(set(xs + ys))
    brute = sum(abs(sum(x <= a for x in xs) / len(xs) - sum(y <= a for y in ys) / len(ys)) * (b - a)
                for a, b in zip(pts, pts[1:]))
    assert abs(r["wasserstein"] - brute) < 1e-9
    assert r["drift_detected"]


def test_exact_ks_pvalue_matches_enumeration(spark):
    import itertools
    from tidemark.functions.ks_exact import ks_exact_pvalue
    xs = [0.1, 0.5, 0.9, 1.3, 2.2]
    ys = [0.7, 1.1, 1.9, 2.5, 3.0, 3.3]
    pool = xs + ys
    m, n = len(xs), len(ys)

    def dstat(a, b):
        pts = sorted(a + b)
        return max(abs(sum(x <= p for x in a) / len(a) - sum(y <= p for y in b) / len(b)) for p in pts)

    d0 = dstat(xs, ys)
    hits = total = 0
    for idx in itertools.combinations(range(m + n), m):
        a = [pool[i] for i in idx]
        b = [pool[i] for i in range(m + n) if i not in idx]
        total += 1
        hits += dstat(a, b) >= d0 - 1e-12
    assert abs(ks_exact_pvalue(d0, m, n) - hits / total) < 1e-12
    ref = _df(spark, [(x,) for x in xs], "v double")
    cur = _df(spark, [(y,) for y in ys], "v double")
    r = drift.numeric_drift(ref, cur, ["v"], ks_method="auto").first()
    assert abs(r["p_value"] - hits / total) < 1e-12
    asym = drift.numeric_drift(ref, cur, ["v"], ks_method="asymp").first()["p_value"]
    assert asym != r["p_value"]


def test_type_mismatch_is_an_error_row(spark):
    ref = _df(spark, [(1.0, "a"), (2.0, "b")], "x double, c string")
    cur = _df(spark, [("oops", "a"), ("1.5", "b")], "x string, c string")
    rows = {r["column"]: r for r in drift.detect_drift(ref, cur, {}).columns.collect()}
    assert rows["x"]["error"].startswith("unsupported type") and not rows["x"]["drift_detected"]
    assert rows["c"]["kind"] == "categorical"


def test_reference_profile_gives_same_result(spark, tmp_path):
    ref = spark.range(500).select((F.col("id") % 13).cast("double").alias("x"),
                                  F.concat(F.lit("k"), (F.col("id") % 4).cast("string")).alias("c"))
    cur = spark.range(300).select(((F.col("id") * 3) % 17).cast("double").alias("x"),
                                  F.concat(F.lit("k"), (F.col("id") % 6).cast("string")).alias("c"))
    direct = {r["column"]: tuple(r) for r in drift.detect_drift(ref, cur, {}).columns.collect()}
    path = drift.reference_profile(ref, {}, str(tmp_path / "profile"))
    cached = {r["column"]: tuple(r) for r in drift.detect_drift(ref, cur, {}, profile_path=path).columns.collect()}
    assert set(direct) == set(cached) == {"x", "c"}
    for k in direct:
        a, b = direct[k], cached[k]
        assert a[:3] == b[:3] and a[6:] == b[6:]
        for x, y in zip(a[3:6], b[3:6]):
            assert (x is None and y is None) or abs(x - y) < 1e-12


@pytest.mark.parametrize("x,k,p", [(0.0, 3, 1.0), (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
                                   (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (0.01, 1, 0.9203443), (1500.0, 1000, 0.0), (30.0, 5, 1.4748e-05)])
def test_chi_square_tail(spark, x, k, p):
    from tidemark.functions.exprs import chi_square_pvalue
    got = spark.range(1).select(chi_square_pvalue(F.lit(x), F.lit(k)).alias("p")).first()["p"]
    assert abs(got - p) < 1e-6


@pytest.mark.parametrize("z", [0.0, 0.3, 1.0, 1.959963984540054, 2.82, 2.83, 5.0, -3.0])
def test_normal_tail(spark, z):
    from tidemark.functions.exprs import normal_two_sided
    got = spark.range(1).select(normal_two_sided(F.lit(z)).alias("p")).first()["p"]
    assert abs(got - math.erfc(abs(z) / math.sqrt(2))) < 1e-12


def test_share_tests_on_edge_columns(spark):
    ref = spark.createDataFrame([("a", "x", "u", None), ("b", "x", "v", None), ("a", "x", "w", None)], "p string, one string, three string, none string")
    cur = spark.createDataFrame([("a", "x", "u", None), ("a", "x", "z", None)], ref.schema)
    chi = {r["column"]: r for r in drift.chi_square_drift(ref, cur, ref.columns).collect()}
    assert chi["p"]["degrees_of_freedom"] == 1 and abs(chi["p"]["statistic"] - 1.0) < 1e-9
    assert chi["one"]["p_value"] is None and chi["none"]["statistic"] is None and not chi["one"]["drift_detected"]
    assert math.isinf(chi["three"]["statistic"]) and chi["three"]["p_value"] == 0 and chi["three"]["drift_detected"]
    z = {r["column"]: r for r in drift.proportion_drift(ref, cur, ref.columns).collect()}
    assert abs(z["p"]["statistic"] + (1 / 3) / math.sqrt(0.8 * 0.2 * (1 / 3 + 1 / 2))) < 1e-9
    assert z["one"]["p_value"] == 1 and z["three"]["p_value"] is None and z["none"]["p_value"] is None


def test_nan_is_missing_and_names_are_free(spark):
    nan = float("nan")
    ref = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "`a.b` double")
    cur = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (nan,), (nan,)], "`a.b` double")
    r = drift.numeric_drift(ref, cur, ["a.b"]).first()
    assert r["statistic"] == 0 and r["n_current"] == 3
    assert drift.wasserstein_drift(ref, cur, ["a.b"]).first()["wasserstein"] == 0
    assert drift.categorical_drift(ref, cur, ["a.b"]).first()["n_current"] == 3


def test_stored_profile_is_reused_and_checked(spark, tmp_out):
    ref = spark.createDataFrame([(float(i % 5), "x" if i % 2 else "y") for i in range(60)], "v double, c string")
    ref.write.parquet(f"{tmp_out}/ref.parquet")
    cfg = {"reference_data_path": f"{tmp_out}/ref.parquet", "reference_profile_path": f"{tmp_out}/profile"}
    drift.DataDriftMonitor(spark, cfg)
    import os
    before = os.stat(f"{tmp_out}/profile/numeric/_SUCCESS").st_mtime_ns
    monitor = drift.DataDriftMonitor(spark, cfg)
    assert os.stat(f"{tmp_out}/profile/numeric/_SUCCESS").st_mtime_ns == before
    assert not monitor.detect_drift(ref).summary.first()["data_drift_detected"]
    with pytest.raises(ValueError, match="rebuild"):
        drift.DataDriftMonitor(spark, {**cfg, "categorical_columns": ["v"]})


def test_preset_picks_a_test_for_each_column(spark):
    from tidemark.operators import drift
    n = 1200
    ref = spark.range(n).selectExpr("id", "id * 1.5 AS num", "CAST(id % 3 AS STRING) AS cat", "CAST(NULL AS DOUBLE) AS gone", "CAST(id % 2 AS INT) AS `b.c`",
                                    "7.0D AS same", "CASE WHEN id % 4 = 0 THEN id * 1.0D END AS thin", "CAST(id AS STRING) AS moved", "CASE WHEN id < 10 THEN 'x' END AS short")
    cur = ref.withColumns({"num": F.col("num") + 900, "moved": F.lit("other"), "short": F.lit("y")}).drop("id")
    got = drift.preset_drift(ref, cur)
    rows = {r["column"]: r for r in got.columns.collect()}
    assert {c: r.method for c, r in rows.items()} == {
        "num": "wasserstein", "cat": "jensen_shannon", "gone": "none", "b.c": "jensen_shannon", "same": "jensen_shannon", "thin": "ks_test",
        "moved": "jensen_shannon", "short": "z_test"}
    assert {c for c, r in rows.items() if r.drift_detected} == {"num", "moved", "short"}
    assert rows["same"].statistic == 0 and rows["thin"].p_value == 1.0 and rows["thin"].n_reference == 300
    s = got.summary.first()
    assert (s.columns_drifted, s.tested_columns, s.drift_score, s.data_drift_detected) == (3, 8, 3 / 8, False)
    none = drift.preset_drift(ref.limit(0), cur)
    assert {r.method for r in none.columns.collect()} == {"none"} and not none.summary.first().data_drift_detected
    assert drift.preset_drift(ref.select("id"), cur.select("num")).columns.count() == 0
