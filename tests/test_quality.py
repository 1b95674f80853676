from datetime import date

import pytest
from pyspark.sql import functions as F

from periodgrid.operators import profile, quality
from periodgrid.operators.joins import join_hot_keys
from periodgrid.operators.ranking import lag_change, rank_descending, share_of_total, top_k
from periodgrid.plans.runs import compare_runs, recommendation_metrics


def test_rank_with_ties_nulls_and_a_hot_value(spark):
    values = [7.0] * 400 + [float(i % 90) for i in range(500)] + [None] * 20 + [1e9, -5.5]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
    known = sorted((v for v in values if v is not None), reverse=True)
    first = {}
    for place, v in enumerate(known, 1):
        first.setdefault(v, place)
    got = {r.id: r.puesto for r in rank_descending(df, "v", buckets=16).collect()}
    assert len(got) == len(values)
    for i, v in enumerate(values):
        assert got[i] == (first[v] if v is not None else len(known) + 1)


def test_rank_of_nothing(spark):
    assert rank_descending(spark.createDataFrame([], "v double"), "v").count() == 0


@pytest.mark.parametrize("limit", [10**6, 0])
def test_hot_key_join_keeps_every_row(spark, limit):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(300)], "i int, k string")
    small = spark.createDataFrame([("hot", 1), (None, 2), ("cold", 3)], "k string, n int")
    joined = join_hot_keys(facts, small, ["k"], limit)
    assert joined.columns == ["i", "k", "n"]
    assert sorted((r.i, r.n) for r in joined.collect()) == [(i, 1 if i % 3 else 2) for i in range(300)]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, v int")
    assert [r.k for r in top_k(df, "v", "k", 2).collect()] == ["a", "b"]


def test_lag_and_share(spark, rows_of):
    df = spark.createDataFrame([(2021, "a", 50.0), (2022, "a", 50.5), (2022, "b", 49.5)], "anio int, k string, v double")
    assert rows_of(lag_change(df, "v", "anio", ["k"], "d"), "k", "anio", "d") == [
        ("a", 2021, None), ("a", 2022, 0.5), ("b", 2022, None)]
    assert rows_of(share_of_total(df, "v", ["anio"], "s"), "anio", "k", "s") == [
        (2021, "a", 100.0), (2022, "a", 50.5), (2022, "b", 49.5)]


def test_missing_months(spark, rows_of):
    days = [("a", date(2021, 11, 3)), ("a", date(2021, 11, 9)), ("a", date(2022, 2, 1)), ("b", date(2020, 1, 1))]
    df = spark.createDataFrame(days, "k string, fecha date")
    assert rows_of(quality.missing_months(df, ["k"])) == [("a", date(2021, 12, 1)), ("a", date(2022, 1, 1))]


def test_outliers(spark, rows_of):
    df = spark.createDataFrame([("a", float(v)) for v in [1] * 20 + [50]] + [("b", 3.0), ("b", 3.0), ("c", 1.0)], "g string, v double")
    assert rows_of(quality.outliers(df, ["g"], "v", 3.0), "g", "v") == [("a", 50.0)]


def test_reports(spark, rows_of):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "i int, s string")
    inv = quality.inventory([("L", "a", a), ("L", "b", a.limit(0))])
    assert rows_of(inv) == [("L", "a", 3), ("L", "b", 0)]
    assert rows_of(quality.non_empty(inv), "tabla", "no_vacia") == [("a", True), ("b", False)]
    after = quality.inventory([("L", "a", a.limit(2))])
    assert rows_of(quality.retention(inv, after)) == [("a", 3, 2, 1, 66.67), ("b", 0, 0, 0, None)]
    assert rows_of(quality.range_check(a, {"i": (2, 9)})) == [("i", 1)]
    assert rows_of(quality.repeated_keys(a, ["i"])) == [(2, 2)]
    order = quality.layer_order(F.col("capa"), ("X", "L"))
    assert inv.select(order).first()[0] == 2


def test_profile(spark, rows_of):
    a = spark.createDataFrame([(0, None, 1), (1, "x", 1), (2, "y", 2), (3, None, 1)], "pos int, s string, n int")
    assert rows_of(profile.shape(a, "t")) == [("t", 4, 3)]
    assert rows_of(profile.null_counts(a)) == [("n", 0), ("pos", 0), ("s", 2)]
    assert rows_of(profile.distinct_counts(a, ["s", "n"])) == [("n", 2), ("s", 2)]
    assert rows_of(profile.distinct_counts(a, ["s"], approximate=True)) == [("s", 2)]
    assert rows_of(profile.type_histogram(a)) == [("int", 2, 8), ("string", 1, 2)]
    assert rows_of(profile.value_range(a, "n")) == [(1, 2)]
    assert [r.s for r in profile.first_values(a, "s", ["pos"], 2).collect()] == [None, "x"]
    assert profile.first_columns(a, 2) == ["pos", "s"]


def test_null_groups_and_keys_count(spark, rows_of):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 4.0)], "g string, v double")
    assert rows_of(share_of_total(rows, "v", ["g"]), "g", "participacion_pct") == [("a", 25.0), ("a", 75.0), (None, 100.0)]
    assert rows_of(share_of_total(rows, "v", []), "participacion_pct") == [(12.5,), (37.5,), (50.0,)]
    counts = spark.createDataFrame([(None, 5), ("t", 2)], "tabla string, num_filas long")
    assert rows_of(quality.retention(counts, counts), "tabla", "filas_perdidas") == [("t", 0), (None, 0)]


def test_no_recommendations_count_as_zero(spark, rows_of):
    empty = spark.createDataFrame([], "instrumento_recomendado string, prioridad string, tasa_informalidad_promedio_miles double")
    got = dict(rows_of(recommendation_metrics(empty), "metrica", "valor"))
    assert got["total_ciudades_analizadas"] == 0 and got["ciudades_prioridad_alta"] == 0


def test_newest_record_of_a_run_counts(spark, rows_of):
    rows = spark.createDataFrame([("r", "k", 1.0, 1), ("r", "k", 2.0, 2), ("s", "k", 5.0, 1)], "run_id string, clave string, valor double, ts long")
    assert rows_of(compare_runs(rows, ["k"])) == [("r", 2.0), ("s", 5.0)]
