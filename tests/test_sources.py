from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabprep.functions.names import clean_name, clean_names, unique_names
from tabprep.functions.text import missing_to_null, nan_to_null, parse_date, parse_number
from tabprep.operators.roles import (
    ColumnRoles, abs_numeric, coerce_datetime, coerce_numeric, detect_roles, drop_columns, drop_null_rows,
    numeric_columns,
)
from tabprep.sources.files import file_format, infer_types, load, read_any, read_csv, read_json, save, spans_lines

MENU = '''Company,Item,Calories,"Calories from\nFat",Total Fat (g),Crème  Brûlée,Served
A,"Burger, large","1,200",500, 5 ,<1,2024-01-05
A,Fries,300,N/A,-7,2,2024-01-06
B,"Say ""hi""",,10,1d,3.5,x
A,Fries,300,N/A,-7,2,2024-01-06
'''


@pytest.fixture
def menu(tmp_path):
    path = tmp_path / "menu.csv"
    path.write_text(MENU)
    return str(path)


@pytest.mark.parametrize("raw,clean", [
    ("Total Fat (g)", "total_fat_g"), ("Calories from\nFat", "calories_from_fat"), ("  A   B ", "a_b"),
    ("café x", "cafe_x"), ("Crème", "cre_me"), ("__x__", "x"), ("", "col"), ("%", "col"), ("a--b__c", "a_b_c"),
])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_unique_names():
    assert unique_names(["x", "x", "x"]) == ["x", "x_1", "x_2"]
    assert unique_names(["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    assert unique_names(["a", "a_1", "a"]) == ["a", "a_1", "a_2"]
    got = unique_names(["a", "a", "a_1", "a_1", "a"])
    assert len(set(got)) == 5
    assert clean_names(["A", "a "]) == ["a", "a_1"]


def test_csv(spark, menu):
    assert spans_lines(spark, menu)
    df = read_csv(spark, menu)
    assert df.columns[3] == "Calories from\nFat"
    rows = df.collect()
    assert rows[0]["Item"] == "Burger, large" and rows[2]["Item"] == 'Say "hi"'
    assert rows[1]["Calories from\nFat"] is None
    assert dict(df.dtypes)["Calories from\nFat"] == "bigint"


def test_load(spark, menu):
    df, roles = load(spark, menu)
    assert df.columns == ["company", "item", "calories", "calories_from_fat", "total_fat_g", "cre_me_bru_le_e", "served"]
    assert df.count() == 3                      # one exact repeat dropped
    got = {r["item"]: r for r in df.collect()}
    assert got["Burger, large"]["calories"] == 1200.0
    assert got["Burger, large"]["total_fat_g"] == 5.0
    assert got["Burger, large"]["cre_me_bru_le_e"] is None
    assert got['Say "hi"']["total_fat_g"] is None
    assert roles.categorical == ("company", "item")
    assert "served" in roles.numeric            # from the third column on everything is taken as numbers


def test_csv_splits_when_it_can(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text('a,b\n"x, ""y""",1\n')
    assert not spans_lines(spark, str(path))
    assert read_csv(spark, str(path)).collect()[0]["a"] == 'x, "y"'


def test_repeated_and_missing_headers(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("a,a,,b\n1,2,3,x\n")
    df = read_csv(spark, str(path))
    assert df.columns == ["a", "a_1", "Unnamed: 2", "b"]
    assert tuple(df.first()) == (1, 2, 3, "x")


def test_header_only(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("a,b\n")
    df = read_csv(spark, str(path))
    assert df.columns == ["a", "b"] and df.count() == 0


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "x", None, "9" * 25), (" 2", "-3", "False", "1", None, "1")],
        "i string, d string, b string, s string, n string, big string")
    assert dict(infer_types(df).dtypes) == {
        "i": "bigint", "d": "double", "b": "boolean", "s": "string", "n": "double", "big": "double"}


def test_json(spark, tmp_path):
    records = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    array, lines = tmp_path / "a.json", tmp_path / "l.json"
    array.write_text(json.dumps(records, indent=1))
    lines.write_text("\n".join(json.dumps(r) for r in records))
    for path in (array, lines):
        assert sorted(map(tuple, read_json(spark, str(path)).select("a", "b").collect())) == [(1, "x"), (2, None)]


def test_formats(spark, tmp_path):
    assert file_format("/x/y.CSV") == "csv" and file_format("/x/y.parquet/") == "parquet"
    with pytest.raises(ValueError):
        file_format("x.xlsx")
    with pytest.raises(AnalysisException):
        read_any(spark, str(tmp_path / "none.json"))


@pytest.mark.parametrize("suffix", ["csv", "json", "parquet"])
def test_roundtrip(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, 'a,"b"', 0.1), (2, None, None), (3, "line\nend", 2.0)], "k bigint, t string, v double")
    path = str(tmp_path / f"out.{suffix}")
    save(df, path)
    assert sorted(map(tuple, read_any(spark, path).select("k", "t", "v").collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(AnalysisException):
        save(df, path)
    save(df, path, mode="overwrite")


def test_parse_number(spark):
    texts = ["1,200", " 5 ", "<1", "1d", "1f", "0x1p3", "1e400", "-2.5e3", ".5", "5.", "1_000", "", "NaN", "+3", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_number(F.col("t")))
    assert [r[0] for r in df.collect()] == [
        1200.0, 5.0, None, None, None, None, None, -2500.0, 0.5, 5.0, None, None, None, 3.0, None]


def test_parse_date(spark):
    texts = ["2024-01-05", "2024-1-5", "24-01-05", " 2024-01-05", "2024-01-05 10:00", "2024-13-01", "2024-02-30", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date(F.col("t")))
    assert [r[0] is not None for r in df.collect()] == [True, True] + [False] * 7


def test_missing_and_nan(spark):
    df = spark.createDataFrame([("N/A", float("nan")), ("x", 1.0)], "t string, v double")
    got = nan_to_null(df.select(missing_to_null(F.col("t")).alias("t"), "v")).collect()
    assert [tuple(r) for r in got] == [(None, None), ("x", 1.0)]


def test_roles(spark):
    df = spark.sql(
        "select 1 i, 1.5d d, cast(1 as decimal(5,2)) m, true b, 'x' s, '2024-01-05' t, date '2024-01-01' day, "
        "timestamp_ntz '2024-01-01 00:00:00' ts, array(1) a")
    out, roles = detect_roles(df)
    assert roles == ColumnRoles(("i", "d", "m"), ("s",), ("t", "day", "ts"))
    assert dict(out.dtypes)["t"] == "timestamp"
    assert roles.without(["i", "t"]).numeric == ("d", "m")
    with pytest.raises(ValueError):
        numeric_columns(df, ["s"])


def test_one_date_is_enough(spark):
    df = spark.createDataFrame([("2024-01-05",), ("x",), ("y",)], "t string")
    assert coerce_datetime(df).where("t is null").count() == 2
    assert dict(coerce_datetime(df, min_date_share=0.5).dtypes)["t"] == "string"


def test_coercion_by_position(spark):
    df = spark.createDataFrame([("1", "2", "3", 4)], "a string, b string, c string, d int")
    assert [t for _, t in coerce_numeric(df).dtypes] == ["string", "string", "double", "int"]
    assert [t for _, t in coerce_numeric(df, cols=["a"]).dtypes] == ["double", "string", "string", "int"]


def test_small_projections(spark):
    df = spark.createDataFrame([(-1, -2.5, "x"), (3, None, None)], "a int, b double, c string")
    assert [tuple(r) for r in abs_numeric(df).collect()] == [(1, 2.5, "x"), (3, None, None)]
    assert [tuple(r) for r in abs_numeric(df, ["a"]).collect()][0] == (1, -2.5, "x")
    assert drop_columns(df, ["c", "nope"]).columns == ["a", "b"]
    assert drop_null_rows(df, ["b"]).count() == 1 and drop_null_rows(df, []).count() == 2
