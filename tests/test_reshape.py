from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from periodgrid.functions.periods import MONTHS_ES, PeriodGrammar
from periodgrid.operators.reshape import column_accounting, explode_cells, to_long

WIDE = "Concepto string, Ene string, `Ene.1` string, `Abr*` string, `Ene - mar.7` string, `Unnamed: 5` string, `Ene.9` string"


def test_wide_to_long(spark, rows_of):
    wide = spark.createDataFrame([
        ("a", "1", "x", None, " 2.5 ", "9", "9"),
        (None, None, "1,5", "-3", "inf", "9", "9"),
        ("vacía", None, None, None, None, None, None),
    ], WIDE)
    long = to_long(wide)
    assert long.columns == ["indicador", "anio", "mes", "mes_num", "fecha", "periodo", "valor"]
    assert rows_of(long) == sorted([
        ("a", 2021, "Ene", 1, date(2021, 1, 1), "Ene", 1.0),
        ("a", 2028, "Ene", 1, date(2028, 1, 1), "Ene - mar.7", 2.5),
        (None, 2021, "Abr", 4, date(2021, 4, 1), "Abr*", -3.0),
        (None, 2028, "Ene", 1, date(2028, 1, 1), "Ene - mar.7", float("inf")),
    ], key=repr)


def test_typed_columns_and_nan(spark, rows_of):
    wide = spark.createDataFrame([("a", 1.5, float("nan")), ("b", None, 2.0)], "c string, Ene double, Feb double")
    assert rows_of(to_long(wide), "indicador", "mes", "valor") == [("a", "Ene", 1.5), ("b", "Feb", 2.0)]


def test_mixed_column_types(spark, rows_of):
    wide = spark.createDataFrame([("a", 1, "2,0", 3.5)], "c string, Ene int, Feb string, Mar double")
    assert rows_of(to_long(wide), "mes", "valor") == [("Ene", 1.0), ("Mar", 3.5)]


def test_repeated_and_quoted_names(spark, rows_of):
    wide = spark.createDataFrame([("a", "1", "2", "k")], "c string, x string, y string, z string")
    renamed = wide.toDF("it's", "Ene - mar's", "Ene", "tag")
    long = to_long(renamed, "ind", keep=("tag",))
    assert rows_of(long, "tag", "periodo", "valor") == [("k", "Ene - mar's", 1.0), ("k", "Ene", 2.0)]


def test_no_period_column(spark):
    long = to_long(spark.createDataFrame([("a", "1")], "c string, Total string"))
    assert long.count() == 0 and long.columns[-1] == "valor"


def test_no_python_and_no_unused_column_in_the_plan(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame([("a", "1", "x", "2", "3", "4", "5")], WIDE).write.parquet(path)
    plan = to_long(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert "Unnamed: 5" not in plan and "Ene.9" not in plan
    assert plan.count("RLIKE") == 2  # one guard per form, computed once


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.sampled_from(MONTHS_ES), st.integers(0, 2)),
    st.integers(-10**6, 10**6), min_size=1, max_size=25,
))
def test_unpivot_undoes_pivot(spark, cells):
    rows = [(k, m + (f".{y}" if y else ""), v / 4) for (k, m, y), v in cells.items()]
    df = spark.createDataFrame(rows, "k string, p string, v double")
    wide = df.groupBy("k").pivot("p", sorted({r[1] for r in rows})).agg(F.first("v"))
    back = to_long(wide, "k", PeriodGrammar(base_year=2000))
    got = {(r.k, r.mes, r.anio - 2000): r.valor for r in back.collect()}
    assert got == {key: v / 4 for key, v in cells.items()}


def test_column_accounting(spark):
    df = spark.createDataFrame([(["Concepto", "Ene", "Ene.9", "Total", "Ene - mar"],)], "e array<string>")
    row = column_accounting(df, "e").first()
    assert (row.columnas, row.validas, row.filtradas) == (4, 2, 2)


def test_cell_grid(spark, rows_of):
    df = spark.createDataFrame([(0, ["a", "", None, "NA", "3"])], "row_idx int, celdas array<string>")
    assert rows_of(explode_cells(df)) == [(0, 0, "a"), (0, 4, "3")]


@pytest.mark.parametrize("bound,years", [(0, {2021}), (2, {2021, 2022, 2023})])
def test_suffix_bound(spark, bound, years):
    wide = spark.createDataFrame([("a", 1.0, 2.0, 3.0)], "c string, Ene double, `Ene.1` double, `Ene.2` double")
    long = to_long(wide, grammar=PeriodGrammar(max_suffix=bound))
    assert {r.anio for r in long.collect()} == years
