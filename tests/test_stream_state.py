"""Folded day state, numeric drift on a stream, and versions under parallel writers."""

import datetime
import math
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs, split
from tidemark.operators.reference_cuts import ReferenceCuts
from tidemark.sources import files
from tidemark.streaming import monitor
from tidemark.streaming.day_state import DayState

SCHEMA = "day date, column string, value string, n long"


def counts(spark, rows):
    return spark.createDataFrame([(d and datetime.date(2024, 1, d), "c", v, n) for d, v, n in rows], SCHEMA)


def held(df):
    return sorted((r.day.day, r.value, r.n) for r in df.collect())


def leaf_files(path):
    import os
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_many_batches_keep_few_files_and_equal_one_batch(spark, tmp_out):
    rng, total = random.Random(3), {}
    state = DayState(spark, f"{tmp_out}/s", "column string, value string", fold_after=4)
    most = 0
    for b in range(24):
        rows = [(rng.randint(1, 3), v, rng.randint(1, 9)) for v in "ab"]
        rows = [(d, v, n) for (d, v), n in {(d, v): n for d, v, n in rows}.items()]
        for d, v, n in rows:
            total[d, v] = total.get((d, v), 0) + n
        got = held(state.add(b, counts(spark, rows).coalesce(1)))
        days = {d for d, _, _ in rows}
        assert got == sorted((d, v, n) for (d, v), n in total.items() if d in days)
        most = max(most, leaf_files(f"{tmp_out}/s"))
    assert held(state.totals()) == sorted((d, v, n) for (d, v), n in total.items())
    assert most <= 3 * spark.sparkContext.defaultParallelism + 2 * 5  # days x files of a fold, days x live batches
    assert len([n for n in files.names(spark, f"{tmp_out}/s") if n.startswith("manifest-")]) == 1


def test_replays_and_crashes_count_a_batch_once(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/s"
    state = DayState(spark, path, "column string, value string", fold_after=2)
    for b in range(4):
        state.add(b, counts(spark, [(1, "a", 1), (None, "a", 9)]))
    assert held(state.add(3, counts(spark, [(1, "a", 1)]))) == [(1, "a", 4)]  # the same batch again
    # a crash before the manifest appears: the new generation is ignored, then overwritten
    monkeypatch.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    for b in (4, 5, 6):
        try:
            state.add(b, counts(spark, [(1, "a", 1)]))
        except OSError:
            pass
    monkeypatch.undo()
    assert held(DayState(spark, path, "column string, value string", fold_after=2).totals()) == [(1, "a", 7)]
    # a crash before the old folders are deleted: they are not counted, and go with the next fold
    monkeypatch.setattr(DayState, "_retire", lambda self, manifest: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        state.add(7, counts(spark, [(1, "a", 1)]))
    monkeypatch.undo()
    for b in (7, 8, 9, 10):
        last = state.add(b, counts(spark, [(1, "a", 1)]))
    assert held(last) == [(1, "a", 11)]
    assert len(files.names(spark, f"{path}/batches")) <= 3
    assert held(state.add(11, counts(spark, []))) == []  # an empty batch touches no day


def test_largest_count_stays_where_counts_only_grow(spark, tmp_out):
    state = DayState(spark, f"{tmp_out}/s", "column string, value string", F.max, fold_after=1)
    for b, n in enumerate([2, 5, 9]):
        last = state.add(b, counts(spark, [(1, "a", n)]))
    assert held(last) == [(1, "a", 9)]


def exact_ks(x, y):
    grid = np.unique(np.concatenate([x, y]))
    return np.abs(np.searchsorted(np.sort(x), grid, "right") / len(x) - np.searchsorted(np.sort(y), grid, "right") / len(y)).max()


@pytest.mark.parametrize("pieces", [1, 7, 64])
def test_bounds_hold_the_exact_statistic(spark, pieces):
    rng = np.random.default_rng(pieces)
    ref = np.concatenate([rng.normal(size=300), np.zeros(150), [-0.0, 5.0]])
    days = {1: rng.normal(0.5, 1, 200), 2: np.zeros(40), 3: np.array([100.0]), 4: np.round(rng.normal(size=90), 1), 5: -np.ones(3)}
    reference = spark.createDataFrame([(float(x),) for x in ref] + [(None,), (math.nan,)], "`a.b` double").repartition(5)
    rows = [(d, float(x)) for d, xs in days.items() for x in xs] + [(1, None), (2, math.nan)]
    current = spark.createDataFrame(rows, "day int, `a.b` double")
    cuts = ReferenceCuts.of(reference, ["a.b"], pieces)
    assert len(cuts.values["a.b"]) <= pieces
    found = cuts.bounds(cuts.counts(reference, []), cuts.counts(current, ["day"]), "day").collect()
    assert {r.day for r in found} == set(days)
    for r in found:
        d = exact_ks(ref, days[r.day])
        assert r.statistic - 1e-12 <= d <= r.statistic_max + 1e-12 and r.statistic_max <= r.statistic + 1 / pieces + 1e-12
        assert (r.n_reference, r.n_current, r.column) == (len(ref), len(days[r.day]), "a.b")
    assert cuts.counts(current, []).count() <= 2 * pieces + 1


def test_columns_without_reference_values(spark):
    empty = spark.createDataFrame([(None, 1.0)], "x double, y double")
    cuts = ReferenceCuts.of(empty, ["x", "y"], 4)
    current = spark.createDataFrame([(1, 2.0, math.inf), (1, None, 1.0)], "day int, x double, y double")
    found = {r.column: r for r in cuts.bounds(cuts.counts(empty, []), cuts.counts(current, ["day"]), "day").collect()}
    assert found["x"].statistic is None and not found["x"].drift_detected and found["x"].n_current == 1
    assert found["y"].statistic == 0.5
    assert cuts.counts(current.limit(0), ["day"]).count() == 0


def test_numeric_stream_over_files_equals_one_batch(spark, tmp_out):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ref = ev.where("event_id % 2 = 0")
    found = []
    for n in (1, 6):
        base = f"{tmp_out}/{n}"
        ev.repartition(n).write.parquet(f"{base}/src")
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
        monitor.start_daily_numeric_drift(stream, ref, ["value"], "ts", f"{base}/out", f"{base}/state", f"{base}/ck", pieces=16, fold_after=2).awaitTermination()
        found.append(sorted((str(r.day), r.statistic, r.statistic_max, r.n_current) for r in spark.read.parquet(f"{base}/out").collect()))
    assert found[0] == found[1] and sum(r[3] for r in found[0]) == ev.where("value IS NOT NULL").count()


def test_parallel_registrations_get_every_version_once(spark, tmp_out):
    path = f"{tmp_out}/versions"
    runs.register_version(spark, path, "m/1", 1)  # registered without a claim: reserved numbers go on from it
    with ThreadPoolExecutor(10) as writers:
        got = list(writers.map(lambda i: runs.register_next(spark, path, "m/1", run_id=f"r{i}"), range(19)))
    assert sorted(got) == list(range(2, 21))
    rows = spark.read.parquet(path).collect()
    assert sorted(r.version for r in rows) == list(range(1, 21)) and len({r.run_id for r in rows}) == 20
    assert runs.register_next(spark, path, "..") == 1
    assert runs.latest_version(spark.read.parquet(path), "m/1")["version"] == 20


def test_stratified_split_sizes_in_every_label(spark):
    rows = [(i, "a") for i in range(500)] + [(i, "b") for i in range(500, 537)] + [(600, "c"), (601, None), (602, None)] + [(7, "a")] * 200
    df = spark.createDataFrame(rows, "k long, y string")
    got = {(r.y, r.split): r["count"] for r in split.assign_stratified_split(df, "y", ["k"], 0.2).groupBy("y", "split").count().collect()}
    for label, n in (("a", 700), ("b", 37), ("c", 1), (None, 2)):
        sizes = dict(zip(("train", "validation", "test"), split.split_sizes(n, 0.2), strict=True))
        assert {s: got.get((label, s), 0) for s in sizes} == sizes
    one = split.assign_stratified_split(df, "y", ["k"], 0.2)
    many = split.assign_stratified_split(df.repartition(9), "y", ["k"], 0.2)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert split.assign_stratified_split(df.limit(0), "y", ["k"]).count() == 0
    with pytest.raises(ValueError):
        split.assign_stratified_split(df, "y", ["k"], 2.0)
