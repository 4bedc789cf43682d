import pytest
from pyspark.sql import functions as F

from lodestat.operators import validation as v

RULES = [v.Required("Gender"), v.OneOf("Gender", ["Male", "Female"]), v.Required("job"), v.Text("job")]


def check(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, Gender string, job string")
    found = v.with_errors(df, RULES).orderBy("row_id").collect()
    return [[(e["field"], e["type"], e["message"], e["input"]) for e in r["errors"]] for r in found]


def test_error_records(spark):
    found = check(spark, ("Male", "Business"), ("Invalid", "Business"), (None, ""), ("Female", "x" * 51), ("Male", "   "))
    assert found[0] == []
    assert found[1] == [("Gender", "literal_error",
                         "Valor inválido para 'Gender'. Valores permitidos: 'Male' or 'Female'", "Invalid")]
    assert found[2] == [("Gender", "missing", "Campo requerido 'Gender' no proporcionado", None),
                        ("job", "string_too_short", "'job' debe tener al menos 2 caracteres", "")]
    assert [e[1] for e in found[3]] == ["string_too_long"]
    assert [e[1] for e in found[4]] == ["value_error"]


def test_expected_text():
    assert v.expected_text(["a"]) == "'a'"
    assert v.expected_text(["a", "b", "c"]) == "'a', 'b' or 'c'"


def test_split_is_complete_and_trims(spark):
    df = spark.createDataFrame([(1, "Male", "  Doctor "), (2, "male", "Doctor")], "row_id long, Gender string, job string")
    valid, rejected = v.split_valid(df, RULES)
    assert [tuple(r) for r in valid.collect()] == [(1, "Male", "Doctor")]
    assert [r["row_id"] for r in rejected.collect()] == [2]


def test_request_sizes(spark):
    rows = [("one", 1)] + [("three", i) for i in range(3)] + [("many", i) for i in range(101)] + [("full", i) for i in range(100)]
    df = spark.createDataFrame(rows, "request string, i int")
    known = spark.createDataFrame([(r,) for r in ("none", "one", "three", "many", "full")], "request string")
    found = {r["request"]: (r["n"], r["accepted"]) for r in v.batch_limits(df, "request", requests=known).collect()}
    assert found == {"none": (0, False), "one": (1, True), "three": (3, True), "many": (101, False), "full": (100, True)}
    assert v.reject_oversized(df, "request").count() == 104


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    v.require_columns(df, ["a"])
    with pytest.raises(ValueError, match="b"):
        v.require_columns(df, ["a", "b"])


def test_envelope(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x"), (2, "x")], "request int, p string")
    rows = {r["request"]: r for r in v.score_envelope(df, "request", "p", F.lit("now")).collect()}
    assert rows[1]["total"] == 3 and rows[1]["predictions"] == '{"x":2,"y":1}' and rows[2]["timestamp"] == "now"
