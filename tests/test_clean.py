import pytest
from pyspark.sql import functions as F

from sieveline.operators import clean
from sieveline.sources import tables
from sieveline.sources.tables import positional_names, read_headerless_csv, rename_by_position


def column(df, name):
    return [r[name] for r in df.collect()]


def test_positional_names():
    assert positional_names(3) == ["feature_1", "feature_2", "target"]
    assert positional_names(1) == ["target"]
    with pytest.raises(ValueError):
        positional_names(0)


def test_rename_by_position(spark):
    df = rename_by_position(spark.createDataFrame([(1, 2)], "a int, b int"))
    assert df.columns == ["feature_1", "target"]
    with pytest.raises(ValueError):
        rename_by_position(df, ["one"])


def test_read_csv_with_inferred_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("1,?,-.1,8\n2,3,.0,6\n")
    df = read_headerless_csv(spark, str(path), infer=True)
    assert [t for _, t in df.dtypes] == ["int", "string", "double", "int"]
    cleaned = clean.cast_to_int(clean.sentinel_to_null(df), ["feature_2"])
    assert sorted(map(tuple, cleaned.collect())) == [(1, None, -0.1, 8), (2, 3, 0.0, 6)]
    assert [t for _, t in read_headerless_csv(spark, str(path)).dtypes] == ["string"] * 4


def test_sentinel_only_touches_text(spark):
    df = spark.createDataFrame([("?", " ? ", 1), ("a?", " b", 2)], "a string, b string, n int")
    rows = clean.sentinel_to_null(df).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(None, None, 1), ("a?", " b", 2)]
    assert clean.columns_of_type(df, "string") == ["a", "b"]


def test_casts_give_null_for_what_cannot_be_read(spark):
    df = spark.createDataFrame([("12",), ("12.7",), ("-3.9",), ("x",), ("",), (None,), ("99999999999",)], "a string")
    assert column(clean.cast_to_int(df, ["a"]), "a") == [12, 12, -3, None, None, None, None]
    assert column(clean.cast_to_double(df, ["a"]), "a") == [12.0, 12.7, -3.9, None, None, None, 99999999999.0]
    assert clean.cast_to_int(df, []).columns == ["a"]
    with pytest.raises(ValueError):
        clean.cast_to_int(df, ["b"])


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, float("nan")), (3, 1.0)], "a int, b double")
    found = {r["column_name"]: (r["nulls"], r["total"]) for r in clean.null_profile(df).collect()}
    assert found == {"a": (1, 3), "b": (1, 3)}
    nan_too = {r["column_name"]: r["nulls"] for r in clean.null_profile(df, nan_as_null=True).collect()}
    assert nan_too == {"a": 1, "b": 2}
    assert clean.null_profile(df, []).count() == 0


def test_null_profile_is_one_scan(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan_of(clean.null_profile(orders, ["o_custkey", "o_totalprice"]))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1), (None, None)], "a int, b int")
    assert clean.drop_sparse_columns(df, ["a", "b"], 0.5).columns == ["a"]
    assert clean.drop_sparse_columns(df, ["a", "b"], 0.75).columns == ["a", "b"]
    assert clean.drop_sparse_columns(df, ["a"], 0.0).columns == ["b"]
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            clean.drop_sparse_columns(df, ["a"], bad)


def test_medians(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (5, 5.0), (6, None)], "a int, b double")
    assert clean.median_values(df, ["a", "b"], "exact") == {"a": 3.5, "b": 2.0}
    assert clean.median_values(df, ["a", "b"], "lower") == {"a": 2, "b": 2.0}
    assert clean.median_values(df, ["a"], "approx", 0.0) == {"a": 2}
    assert clean.median_values(df, ["a"])["a"] in (1.0, 2.0, 5.0)
    assert clean.median_values(df, []) == {}
    with pytest.raises(ValueError):
        clean.median_values(df, ["a"], "mean")


def test_imputing_keeps_the_column_type(spark):
    df = spark.createDataFrame([(1,), (2,), (5,), (6,), (None,)], "a int")
    filled = clean.impute_median(df, ["a"], "exact")
    assert filled.dtypes == [("a", "int")]
    assert sorted(column(filled, "a")) == [1, 2, 3, 5, 6]


def test_imputing_from_the_training_rows(spark):
    df = spark.createDataFrame([(1, "t"), (3, "t"), (100, "v"), (None, "v")], "a int, s string")
    filled = clean.handle_missing(df, ["a"], method="exact", fit_on=df.where("s = 't'"))
    assert sorted(column(filled, "a")) == [1, 2, 3, 100]


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    assert clean.handle_missing(df, ["a", "b"]).columns == ["b"]
    for method in ("approx", "exact", "lower"):
        assert column(clean.handle_missing(df, ["a"], 1.0, method), "a") == [None, None]
    assert clean.handle_missing(df, []).columns == ["a", "b"]


def test_binarize(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "y int")
    assert column(clean.binarize_label(df, "y"), "y") == [0, 1, 1]
    assert clean.binarize_label(df, "y", 2, "z").columns == ["y", "z"]


def test_projection_reaches_the_scan(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan_of(clean.project_features(orders, ["o_totalprice"], "o_orderstatus"))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


def test_sentinel_and_casts_stay_in_one_generated_stage(spark, sf_dir, plan_of):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("a"))
    text = plan_of(clean.cast_to_int(clean.sentinel_to_null(df), ["a"]))
    assert all(line.lstrip(" +-:").startswith("*(1)") for line in text.splitlines() if "Project" in line)
    assert "Python" not in text and "Exchange" not in text


def test_types_are_told_from_the_values(spark):
    rows = [
        ("1", "1", "-.1", "x", "?", None, " 7 ", "9999999999", "99999999999999999999", "1e3", "?"),
        ("-2", "9999999999", ".0", "1", "?", "", "8", "?", "1", "2.", "3"),
        ("+3", "?", "12", "?", "?", None, "?", "1", "?", "NaN", "4"),
    ]
    columns = [f"c{k}" for k in range(11)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    expected = ["int", "bigint", "double", "string", "string", "string", "int", "bigint", "double", "string", "int"]
    assert list(tables.inferred_types(df, columns).values()) == expected
    assert tables.inferred_types(df, ["c0", "c10"], sentinel=None) == {"c0": "int", "c10": "string"}
    assert tables.inferred_types(df, []) == {} and tables.inferred_types(df.limit(0), ["c0"]) == {"c0": "string"}


def test_inferred_csv_takes_sentinels_for_nulls_at_once(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("1,?,-.1,a\n2,5,.0,?\n?,6,?,b\n")
    df = tables.read_inferred_csv(spark, str(path))
    assert df.dtypes == [("feature_1", "int"), ("feature_2", "int"), ("feature_3", "double"), ("target", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, None, -0.1, "a"), (2, 5, 0.0, None), (None, 6, None, "b")], key=str)
