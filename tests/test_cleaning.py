from helpers import plan

from lodestat.operators import cleaning as c
from lodestat.operators.imputing import fit_medians, fit_modes, minimal_preprocess
from lodestat.plans.clean import make_clean, run_clean
from lodestat.sources.zones import Zones, read_csv, read_if_exists, write_csv
import pytest

ROWS = [
    (1, "Male", "A", "good"), (2, "none", "B", "vg"), (3, "Female", None, "None"), (4, "F", " NaN ", "average"),
    (5, "M", "C", ""), (6, "M", "D", None), (7, "M", "E", " none "),
]
SCHEMA = "row_id long, Gender string, Caste string, Performance string"


def test_target_filter_does_not_trim(spark):
    kept = c.drop_missing_target(spark.createDataFrame(ROWS, SCHEMA), "Performance")
    assert sorted(r["row_id"] for r in kept.collect()) == [1, 2, 4, 7]


def test_feature_filter_trims(spark):
    kept = c.drop_invalid_features(spark.createDataFrame(ROWS, SCHEMA), "Performance")
    assert sorted(r["row_id"] for r in kept.collect()) == [1, 5, 6, 7]


def test_audit_adds_up(spark):
    rows = {(r["rule"], r["column"]): r["n"] for r in
            c.cleaning_audit(spark.createDataFrame(ROWS, SCHEMA), "Performance").collect()}
    assert rows[("rows_in", None)] == 7 and rows[("missing_target", "Performance")] == 3
    assert rows[("rows_out", None)] == 2 and rows[("invalid_features", None)] == 2
    assert rows[("invalid_value", "Gender")] == 1 and rows[("invalid_value", "Caste")] == 1


def test_label_filter_keeps_rows_without_label(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert c.drop_label(df, "Performance", "None").count() == 6


def test_aliases_and_projection(spark):
    df = spark.createDataFrame([(1, None, "vg"), (2, "good", None)],
                               "row_id long, `Class_ X_Percentage` string, Class_X_Percentage string")
    out = c.resolve_aliases(df, {"Class_ X_Percentage": ["Class_X_Percentage"]})
    assert out.columns == ["row_id", "Class_ X_Percentage"]
    assert [r[1] for r in out.orderBy("row_id").collect()] == ["vg", "good"]
    assert c.select_features(df, ["nope", "Class_X_Percentage"]).columns == ["Class_X_Percentage"]


def test_clean_chain(spark, tmp_path):
    rows = [(str(i), "  A  ", f"${i}00", "Good", str(i % 2)) for i in range(40)] + [("40", None, "", "VG", "1")]
    df = spark.createDataFrame(rows, "n string, cat string, money string, target string, mixed_type_col string")
    clean = make_clean(df, "none")
    assert clean.columns == ["n", "cat", "money", "target"]
    assert {r["cat"] for r in clean.collect()} == {"a", "none"}
    assert dict(clean.dtypes)["money"] == "bigint"
    assert "PythonUDF" not in plan(clean)
    again = make_clean(clean, "none")
    assert sorted(again.collect()) == sorted(clean.collect())
    zones = Zones(str(tmp_path))
    run_clean(spark, zones, df, "clean")
    assert zones.load_interim(spark, "clean").count() == 41


def test_clean_all_null_and_zero_rows(spark):
    nulls = spark.createDataFrame([(None, None)], "a string, b string")
    assert make_clean(nulls, "none").count() == 1
    empty = spark.createDataFrame([], "a string, b string")
    assert make_clean(empty).columns == ["a", "b"] and make_clean(empty).count() == 0


def test_impute(spark):
    df = spark.createDataFrame(
        [(1.0, "A", 10.0), (2.0, "B", 20.0), (None, None, 30.0), (4.0, "A", None), (5.0, "B", 50.0)],
        "a double, cat string, b double")
    out, roles = minimal_preprocess(df)
    assert roles.categorical == ["a", "cat", "b"]
    row = out.filter("b = 30").first()
    assert (row["a"], row["cat"]) == (1.0, "A")
    assert out.filter("a = 4").first()["b"] == 10.0
    assert fit_medians(df, ["a", "b"]) == {"a": 3.0, "b": 25.0}


def test_mode_of_numbers_breaks_ties_by_value_and_empty_column_fails(spark):
    df = spark.createDataFrame([(10, None), (9, None)], "n long, e string")
    assert fit_modes(df, ["n"]) == {"n": "9"}
    with pytest.raises(ValueError, match="no mode"):
        fit_modes(df, ["e"])


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("$100", 'say "hi", ok', "x y"), ("50%", "NA", None)], "a string, b string, `c d` string")
    path = write_csv(df, str(tmp_path / "t"))
    back = sorted(read_csv(spark, path).collect())
    assert back == [("$100", 'say "hi", ok', "x y"), ("50%", None, None)]
    assert read_if_exists(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Zones(str(tmp_path)).load_interim(spark, "missing")
    assert Zones(str(tmp_path)).load_original_if_exists(spark, "missing") is None
