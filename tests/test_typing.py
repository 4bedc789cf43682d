import pytest
from helpers import column, plan, texts

from lodestat.functions import text
from lodestat.operators.typing import basic_typing, coerce_numeric, fit_typing, small_cardinalities, split_num_cat
from pyspark.sql import functions as F


@pytest.mark.parametrize("values, kind, expected", [
    (["1", "2", "3", "4", "5"], "bigint", [1, 2, 3, 4, 5]),
    (["$100", "$200", "$300"], "bigint", [100, 200, 300]),
    (["50%", "75%", "100%"], "bigint", [50, 75, 100]),
    (["1,000", "$2,000", "3,000"], "bigint", [1000, 2000, 3000]),
    (["  100  ", "\t200 ", " 300\x1c"], "bigint", [100, 200, 300]),
    (["hello", "world", "test"], "string", ["hello", "world", "test"]),
    (["100", "nan", "None", "200", "", None], "bigint", [100, None, None, 200, None, None]),
    (["1e3", "+5", ".5", "1.", "-2E-1"], "double", [1000.0, 5.0, 0.5, 1.0, -0.2]),
    (["inf", "-Infinity", "1"], "double", [float("inf"), float("-inf"), 1.0]),
    (["12d", "1"], "string", ["12d", "1"]),
    (["NaN", "1"], "string", ["NaN", "1"]),
    (["1_000", "1"], "string", ["1_000", "1"]),
    (["0x10", "1"], "string", ["0x10", "1"]),
    (["1", "x", "None"], "string", ["1", "x", None]),
    (["", "nan", None], "double", [None, None, None]),
    (["99999999999999999999", "1"], "double", [1e20, 1.0]),
])
def test_all_or_nothing(spark, values, kind, expected):
    typed = coerce_numeric(texts(spark, values), ["s"])
    assert dict(typed.dtypes)["s"] == kind
    assert column(typed, "s") == expected


def test_numbers_pass_untouched_and_input_is_kept(spark):
    df = spark.createDataFrame([(1, 1.5, "$1"), (2, 2.5, "$2")], "a long, b double, c string")
    typed = basic_typing(df)
    assert dict(typed.dtypes) == {"a": "bigint", "b": "double", "c": "bigint"}
    assert dict(df.dtypes)["c"] == "string"


def test_zero_rows_keep_their_columns(spark):
    df = spark.createDataFrame([], "col1 string, col2 string")
    assert fit_typing(df) == {"col1": "string", "col2": "string"}
    assert basic_typing(df).columns == ["col1", "col2"]


def test_typing_is_one_projection(spark):
    shown = plan(basic_typing(texts(spark, ["1", "2"])))
    assert "PythonUDF" not in shown and "Exchange" not in shown


def test_roles(spark):
    df = spark.range(50).select(
        F.col("id").alias("many"), (F.col("id") % 25).alias("few"), F.col("id").cast("double").alias("real"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), (F.col("id") % 2 == 0).alias("flag"))
    roles = split_num_cat(df)
    assert roles.numeric == ["many", "real"]
    assert roles.categorical == ["few", "text", "flag"]


def test_roles_at_the_cap_and_with_missing_values(spark):
    df = spark.range(62).select(
        (F.col("id") % 30).alias("at_cap"), (F.col("id") % 31).alias("above"),
        F.when(F.col("id") > 0, F.col("id").cast("double")).otherwise(float("nan")).alias("gaps"))
    roles = split_num_cat(df)
    assert roles.numeric == ["above", "gaps"]
    assert small_cardinalities(df, df.columns, 62)["gaps"] == (61, 1)


@pytest.mark.parametrize("cap", [2, 30, 200])
def test_screening_never_loses_a_small_column(spark, cap):
    # Many different value sets of exactly `cap` members must all pass the sketch screen.
    df = spark.range(cap * 3).select(*[
        (F.xxhash64(F.col("id") % cap, F.lit(i))).alias(f"c{i}") for i in range(40)])
    found = small_cardinalities(df, df.columns, cap)
    assert {c: v[0] for c, v in found.items()} == {f"c{i}": cap for i in range(40)}


def test_normalise(spark):
    values = ["HELLO", "  hello  ", "hello    world", "MiXeD\tcAsE", "ÀÉ Ü", None]
    df = texts(spark, values)
    keep = column(df.select("row_id", text.normalize_category(F.col("s")).alias("s")), "s")
    assert keep == ["hello", "hello", "hello world", "mixed case", "àé ü", None]
    assert column(df.select("row_id", text.normalize_category(F.col("s"), "nan").alias("s")), "s")[-1] == "nan"
