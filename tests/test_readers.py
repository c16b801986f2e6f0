import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.sources import readers


def test_csv_na_tokens_and_inference(spark, tmp_out):
    p = f"{tmp_out}/t.csv"
    with open(p, "w") as f:
        f.write("a,b,c,d,e\n1,1.5,x,True,NA\n2,N/A,y,false,\n3,2.5,null,TRUE,None\n")
    df = readers.read_table(spark, {"source_type": "csv", "source_path": p})
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "double"}
    nulls = {r["column"]: r["null_count"] for r in quality.null_counts(df).collect()}
    assert nulls == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 3}


def test_type_check_pandas_names(spark):
    df = spark.createDataFrame([(1, 1.0, "x")], "a bigint, b double, c string")
    rows = {r["column"]: r for r in quality.type_check(df, {"a": "int64", "b": "int64", "z": "float64"}).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["matches"] and not rows["b"]["matches"] and rows["b"]["actual"] == "float64"


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b string")
    r = quality.duplicate_stats(df).first()
    assert (r["n_rows"], r["distinct_rows"], r["duplicate_rows"]) == (3, 2, 1)


def test_unsupported_source_type(spark):
    import pytest
    with pytest.raises(ValueError):
        readers.read_table(spark, {"source_type": "xml", "source_path": "/x"})
    with pytest.raises(ValueError):
        readers.read_by_extension(spark, "/x/data.txt")


def test_drift_monitor_from_files(spark, tmp_out):
    import json
    from tidemark.operators import drift, perf
    ref = spark.createDataFrame([("a", float(i)) for i in range(50)] + [("b", 1.0)] * 50, "c string, x double")
    cur = spark.createDataFrame([("b", float(i) + 100) for i in range(60)], "c string, x double")
    ref.coalesce(1).write.option("header", True).csv(f"{tmp_out}/ref.csv")
    cur.write.parquet(f"{tmp_out}/cur.parquet")
    mon = drift.DataDriftMonitor(spark, {"reference_data_path": f"{tmp_out}/ref.csv",
                                         "categorical_columns": ["c"]})
    res = mon.detect_drift(readers.read_by_extension(spark, f"{tmp_out}/cur.parquet"))
    rows = {r["column"]: r for r in res.columns.collect()}
    assert rows["c"]["drift_detected"] and rows["x"]["drift_detected"]
    assert res.summary.first()["data_drift_detected"]
    with open(f"{tmp_out}/base.json", "w") as f:
        json.dump({"accuracy": 0.9, "mse": 1.0}, f)
    pm = perf.ModelPerformanceMonitor(spark, {"baseline_metrics_path": f"{tmp_out}/base.json",
                                              "lower_is_better_metrics": ["mse"]})
    cur_m = spark.createDataFrame([("accuracy", 0.7), ("mse", 1.5)], "metric string, value double")
    changes, summary = pm.detect_performance_degradation(cur_m)
    assert {r["metric"] for r in changes.where("degraded").collect()} == {"accuracy", "mse"}
    assert summary.first()["performance_degradation_detected"]


def test_json_document_and_lines(spark, tmp_out):
    import json
    p = f"{tmp_out}/doc.json"
    with open(p, "w") as f:
        json.dump([{"a": 1, "b": "x", "c": 1.5}, {"a": 2, "b": None, "c": None}], f, indent=2)
    df = readers.read_table(spark, {"source_type": "json", "source_path": p})
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert df.count() == 2
    lines = f"{tmp_out}/lines.json"
    with open(lines, "w") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    assert readers.read_table(spark, {"source_type": "json", "source_path": lines, "lines": True}).count() == 2
    # a list of paths is read whole
    both = readers.read_table(spark, {"source_type": "json", "input_path": [lines, lines], "lines": True})
    assert both.count() == 4


def test_run_monitoring_from_config(spark, tmp_out):
    from tidemark.plans.monitor_job import run_monitoring
    ref = spark.createDataFrame([("a", float(i), "2024-01-01") for i in range(40)], "c string, x double, ts string")
    cur = spark.createDataFrame([("b", float(i) + 50, "2024-02-01") for i in range(40)], "c string, x double, ts string")
    ref.write.parquet(f"{tmp_out}/ref.parquet")
    cur.coalesce(1).write.option("header", True).csv(f"{tmp_out}/cur.csv")
    res = run_monitoring(spark, {"reference_data_path": f"{tmp_out}/ref.parquet",
                                 "current_data_path": f"{tmp_out}/cur.csv", "datetime_column": "ts",
                                 "output_path": f"{tmp_out}/out"})
    assert res.data_drift_detected and sorted(res.drifted_columns) == ["c", "x"]
    assert spark.read.parquet(f"{tmp_out}/out/drift_summary").count() == 1
    assert "computed_at" in spark.read.parquet(f"{tmp_out}/out/drift_columns").columns


@pytest.mark.parametrize("path", ["s3a://bucket/x/t.csv", "hdfs://nn:8020/a//t.parquet", "file:///tmp/t.csv", "/plain/t.csv"])
def test_paths_reach_spark_untouched(path):
    assert readers.resolve_source({"source_type": "csv", "input_path": path})[1] == path
    assert readers.resolve_source({"source_type": "csv", "input_path": [path]})[1] == [path]


def test_csv_numbers_take_no_type_suffix(spark, tmp_out):
    with open(f"{tmp_out}/c.csv", "w") as f:
        f.write('code,num,q\n1D,1e3,"say ""hi"", ok"\n2F,-.5,"two\nlines"\n3d,inf," pad "\n')
    t = readers.read_csv(spark, f"{tmp_out}/c.csv")
    assert dict(t.dtypes) == {"code": "string", "num": "double", "q": "string"}
    assert [r["q"] for r in t.collect()] == ['say "hi", ok', "two\nlines", " pad "]


def test_scratch_tables_can_be_cleared(spark):
    from tidemark.session import clear_scratch, scratch_path
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) and not clear_scratch(spark)


def _document(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return {"source_type": "json", "source_path": str(tmp_path / name)}


def test_json_objects_of_columns(spark, tmp_path):
    df = readers.read_table(spark, _document(tmp_path, "columns.json", """
        {"n": {"0": 1, "1": 2, "10": 3}, "x.y": {"0": 1.5, "1": 2, "10": null}, "s": {"0": "a", "10": "7"},
         "b": {"0": true, "1": false, "10": null}, "mixed": {"0": 1, "1": "u", "10": [1, 2]}, "none": {"0": null, "1": null}}"""))
    assert df.dtypes == [("n", "bigint"), ("x.y", "double"), ("s", "string"), ("b", "boolean"), ("mixed", "string"), ("none", "double")]
    assert sorted((tuple(r) for r in df.collect()), key=lambda r: r[0]) == [
        (1, 1.5, "a", True, "1", None), (2, 2.0, None, False, "u", None), (3, None, "7", None, "[1,2]", None)]


def test_json_objects_of_lists_and_many_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part{k}.json").write_text(f'{{"a": [{k}, {k + 10}], "b": ["x", null]}}')
    df = readers.read_table(spark, {"source_type": "json", "source_path": str(tmp_path)})
    assert sorted(tuple(r) for r in df.where("b IS NOT NULL").collect()) == [(0, "x"), (1, "x"), (2, "x")]
    assert sorted(r["a"] for r in df.collect()) == [0, 1, 2, 10, 11, 12]


def test_json_layout_is_told_by_the_document(spark, tmp_path):
    records = readers.read_table(spark, _document(tmp_path, "records.json", '\n [{"a": 1}, {"a": 2}]'))
    assert sorted(r["a"] for r in records.collect()) == [1, 2]
    with pytest.raises(ValueError, match="columns"):
        readers.read_table(spark, _document(tmp_path, "scalars.json", '{"a": 1, "b": 2}'))
    assert readers.read_table(spark, _document(tmp_path, "empty.json", "{}")).columns == []
    assert readers.read_table(spark, _document(tmp_path, "rowless.json", '{"a": {}, "b": {}}')).count() == 0


def test_json_columns_plan_has_no_field_a_row(spark, tmp_path):
    import json
    wide = {c: {str(i): i * k for i in range(3000)} for k, c in ((1, "a"), (2, "b"))}
    df = readers.read_table(spark, _document(tmp_path, "long.json", json.dumps(wide)))
    assert df.count() == 3000 and df.where("b = 2 * a").count() == 3000
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 6000


def test_cells_of_json_columns_do_not_carry_the_names_of_their_document(spark, tmp_path):
    """variant_explode gives each cell the row keys of the whole file."""
    df = readers.read_table(spark, _document(tmp_path, "kinds.json", '{"a": {"r1": null, "r2": 1.10, "r3": 1e5}, "b": ["x", {"y": [1]}, null], "c": {"r1": null}}'))
    assert "variant_explode" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.dtypes == [("a", "double"), ("b", "string"), ("c", "double")]
    assert sorted(map(str, df.where("a IS NOT NULL OR b IS NOT NULL").collect())) == sorted([
        "Row(a=1.1, b=None, c=None)", "Row(a=100000.0, b=None, c=None)", "Row(a=None, b='x', c=None)", "Row(a=None, b='{\"y\":[1]}', c=None)"])
    assert df.count() == 6


def test_json_columns_query_writes_objects_of_bounded_size(spark, tmp_path, monkeypatch):
    from tidemark.plans import catalog
    rows = spark.range(1, 200).select(F.col("id").alias("c_custkey"), F.concat(F.lit("name "), "id").alias("c_name"), (F.col("id") % 3).alias("c_nationkey"),
                                      (F.col("id") / 8).alias("c_acctbal"), F.lit("m").alias("c_mktsegment"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(catalog, "JSON_ROWS", 20, raising=False)
    df = catalog.q_io_json_columns(spark, str(tmp_path))
    assert len(df.inputFiles()) > 3
    assert sorted(df.drop("c_gaps").collect()) == sorted(rows.collect())
    assert df.where("c_gaps IS NULL").count() == 199 // 7
