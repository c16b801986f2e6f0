import pytest
from pyspark.sql import functions as F

from tidemark.operators import prep


def test_label_codes_sorted_null_last_and_unseen_fails(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    out, fitted = prep.fit_transform(df, [{"type": "encode_categorical", "columns": ["x"]}])
    assert sorted(r["x"] for r in out.collect()) == [0.0, 0.0, 1.0, 2.0, 3.0]
    new = spark.createDataFrame([("a",), ("zzz",)], "x string")
    with pytest.raises(Exception):
        prep.transform(new, fitted).collect()


def test_one_hot_sorted_appended_and_drop_first(spark):
    df = spark.createDataFrame([(1, "B"), (2, "A"), (3, None)], "id int, c string")
    out, fitted = prep.fit_transform(df, [{"type": "encode_categorical", "columns": ["c"],
                                            "method": "one_hot"}])
    assert out.columns == ["id", "c_A", "c_B"]
    assert {tuple(r) for r in out.collect()} == {(1, 0, 1), (2, 1, 0), (3, 0, 0)}
    out2, _ = prep.fit_transform(df, [{"type": "encode_categorical", "columns": ["c"],
                                       "method": "one_hot", "drop_first": True}])
    assert out2.columns == ["id", "c_B"]
    unseen = prep.transform(spark.createDataFrame([(4, "Z")], "id int, c string"), fitted)
    assert tuple(unseen.first()) == (4, 0, 0)


def test_one_hot_category_bound(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        prep.fit_transform(df, [{"type": "encode_categorical", "columns": ["c"],
                                 "method": "one_hot", "max_categories": 10}])


def test_scale_constant_and_single_row_give_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    out, _ = prep.fit_transform(df, [{"type": "scale_numerical", "columns": ["a", "k", "missing"]}])
    rows = out.collect()
    assert sorted(round(r["a"], 9) for r in rows) == [-0.707106781, 0.707106781]
    assert all(r["k"] is None for r in rows)
    one = spark.createDataFrame([(2.0,)], "a double")
    assert prep.fit_transform(one, [{"type": "scale_numerical", "columns": ["a"]}])[0].first()["a"] is None


def test_scale_skips_non_numeric(spark):
    df = spark.createDataFrame([("x", 1.0)], "s string, a double")
    out, _ = prep.fit_transform(df, [{"type": "scale_numerical", "columns": ["s"]}])
    assert out.first()["s"] == "x"


def test_fill_methods(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (2.0, "a"), (None, None), (10.0, "b")],
                               "v double, s string")
    mean = prep.fit_transform(df, [{"type": "fill_missing", "columns": ["v"], "method": "mean"}])[0]
    assert sorted(r["v"] for r in mean.collect()) == pytest.approx([1.0, 2.0, 2.0, 3.75, 10.0])
    med = prep.fit_transform(df, [{"type": "fill_missing", "columns": ["v"], "method": "median"}])[0]
    assert sorted(r["v"] for r in med.collect()) == [1.0, 2.0, 2.0, 2.0, 10.0]
    mode = prep.fit_transform(df, [{"type": "fill_missing", "columns": ["s"], "method": "mode"}])[0]
    assert sorted(r["s"] for r in mode.collect()) == ["a", "a", "a", "b", "b"]  # tie -> smallest
    const = prep.fit_transform(df, [{"type": "fill_missing", "columns": ["v"], "method": "constant",
                                     "value": -1}])[0]
    assert -1.0 in [r["v"] for r in const.collect()]
    with pytest.raises(TypeError):
        prep.fit_transform(df, [{"type": "fill_missing", "columns": ["s"], "method": "mean"}])
    # defaulted columns skip the text column
    allcols = prep.fit_transform(df, [{"type": "fill_missing", "method": "mean"}])[0]
    assert None in [r["s"] for r in allcols.collect()]


def test_median_even_count_and_many_partitions(spark):
    df = spark.range(0, 1001).select((F.col("id") * 3 % 1001).cast("double").alias("v")).repartition(7)
    fills = prep.fit_fill(df, ["v"], "median")
    assert fills["v"] == 500.0
    df2 = spark.range(0, 10).select(F.col("id").cast("double").alias("v"))
    assert prep.fit_fill(df2, ["v"], "median")["v"] == 4.5


def test_mode_all_null_fails(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    with pytest.raises(KeyError):
        prep.fit_fill(df, ["v"], "mode")


def test_chain_order_and_config_shapes(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, "b", None)], "id int, c string, v double")
    steps = [{"type": "drop_duplicates"}, {"type": "fill_missing", "columns": ["v"], "method": "constant", "value": 0},
             {"type": "drop_columns", "columns": ["id", "absent"]}]
    p1 = prep.DataPreprocessor({"preprocessing": {"preprocessing_steps": steps}})
    p2 = prep.DataPreprocessor({"preprocessing_steps": steps})
    a, b = p1.preprocess(df), p2.preprocess(df)
    assert a.columns == ["c", "v"] and a.count() == 2 and b.count() == 2
    with pytest.raises(ValueError):
        prep.fit_transform(df, [{"type": "nonsense"}])


def test_label_codes_are_ranks_of_the_values(spark):
    df = spark.range(200).select(F.concat(F.lit("v"), (F.col("id") % 37).cast("string")).alias("x"),
                                 F.col("id")).union(spark.createDataFrame([(None, 999)], "x string, id long"))
    out, fitted = prep.fit_transform(df, [{"type": "encode_categorical", "columns": ["x"]}])
    order = sorted(f"v{i}" for i in range(37))
    want = {(i, float(order.index(f"v{i % 37}"))) for i in range(200)} | {(999, 37.0)}
    assert {(r["id"], r["x"]) for r in out.collect()} == want


def test_fitted_steps_save_load(spark, tmp_path):
    df = spark.range(60).select(F.col("id"), (F.col("id") % 7).cast("double").alias("v"),
                                F.concat(F.lit("k"), (F.col("id") % 9).cast("string")).alias("c"),
                                F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("o"))
    steps = [{"type": "fill_missing", "columns": ["v"], "method": "median"},
             {"type": "encode_categorical", "columns": ["c"]},
             {"type": "encode_categorical", "columns": ["o"], "method": "one_hot"},
             {"type": "scale_numerical", "columns": ["v"]}]
    out, fitted = prep.fit_transform(df, steps)
    prep.save_fitted(fitted, str(tmp_path / "prep"))
    back = prep.load_fitted(spark, str(tmp_path / "prep"))
    again = prep.transform(df, back)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in again.collect())


def test_approx_median_option(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    fills = prep.fit_fill(df, ["v"], "median", approx=True)
    assert abs(fills["v"] - 500.0) <= 1.0


def test_one_hot_vectors_and_long_form(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import prep
    fit = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "`x.y` string")
    new = spark.createDataFrame([(1, "a", "k"), (2, "c", "k"), (3, None, None), (4, "unseen", "l"), (5, "a", "k")], "id int, `x.y` string, z string")
    text = lambda df: {r.id: r.v for r in df.select("id", F.col("v").cast("string").alias("v")).collect()}
    got = prep.apply_one_hot_vector(new, prep.fit_one_hot_codes(fit, "x.y"), "v")
    assert got.columns == ["id", "z", "v"]
    assert text(got) == {1: "(3,[0],[1.0])", 2: "(3,[2],[1.0])", 3: "(3,[],[])", 4: "(3,[],[])", 5: "(3,[0],[1.0])"}
    got = prep.apply_one_hot_vector(new, prep.fit_one_hot_codes(fit, "x.y", drop_first=True), "v")
    assert text(got) == {1: "(2,[],[])", 2: "(2,[1],[1.0])", 3: "(2,[],[])", 4: "(2,[],[])", 5: "(2,[],[])"}
    none = prep.apply_one_hot_vector(new, prep.fit_one_hot_codes(fit.where("`x.y` IS NULL"), "x.y"), "v")
    assert none.count() == 5 and [r.v.size for r in none.collect()] == [0] * 5
    assert prep.apply_one_hot_vector(new.limit(0), prep.fit_one_hot_codes(fit, "x.y"), "v").count() == 0
    long = sorted(map(tuple, prep.one_hot_long(new, ["id"], ["x.y", "z"]).collect()))
    assert long == [(1, "x.y", "a"), (1, "z", "k"), (2, "x.y", "c"), (2, "z", "k"), (4, "x.y", "unseen"), (4, "z", "l"), (5, "x.y", "a"), (5, "z", "k")]
