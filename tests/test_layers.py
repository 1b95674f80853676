"""Cleaning, Gold tables, rules and run records on rows written by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from periodgrid.operators import gold, kpis
from periodgrid.operators.rules import (
    Rule,
    Thresholds,
    default_rules,
    first_match,
    first_match_by_table,
    priority,
    priority_rank,
    recommend,
    rule_table,
    severity_band,
)
from periodgrid.operators.silver import SilverSpec, clean
from periodgrid.plans.layers import LEVELS
from periodgrid.plans.runs import compare_runs, recommendation_metrics

BRONZE = "c string, anio int, mes string, mes_num int, fecha date, periodo string, valor double, a string"


def test_clean_national(spark, rows_of):
    bronze = spark.createDataFrame([
        ("  TGP ", 2021, "Ene", 1, None, "Ene", 61.005, "f"),
        ("TGP", 2021, "Ene*", 1, None, "Ene*", 1.0, "f"),
        ("TGP", 2021, "Unnamed: 3", 1, None, "p", 1.0, "f"),
        ("TGP", 2021, None, 1, None, "p", 1.0, "f"),
        ("TGP", 2021, "Feb", None, None, "p", 1.0, "f"),
        (None, 2021, "Feb", 2, None, "p", 1.0, "f"),
        ("TGP", 2021, "Feb", 2, None, "p", None, "f"),
        ("TGP", None, "Feb", 2, None, "p", 2.0, "f"),
    ], BRONZE)
    spec = SilverSpec("c", columns=("anio", "mes", "fecha"), lineage=("a",), named_months=True)
    assert rows_of(clean(bronze, spec)) == sorted([
        ("TGP", 2021, "Ene", date(2021, 1, 1), 61.01, "f"),
        ("TGP", None, "Feb", None, 2.0, "f"),
    ], key=repr)


def test_excluded_value_is_compared_before_trim(spark, rows_of):
    bronze = spark.createDataFrame(
        [("No informa", 1.0), (" No informa", 2.0), ("x", 3.0)], "r string, valor double"
    )
    spec = SilverSpec("r", "v", (), (), ("No informa",))
    assert rows_of(clean(bronze, spec)) == [("No informa", 2.0), ("x", 3.0)]


def test_month_13_has_no_date(spark):
    bronze = spark.createDataFrame([("x", 2021, 13, 1.0)], "c string, anio int, mes_num int, valor double")
    spec = SilverSpec("c", columns=("fecha",), lineage=())
    assert clean(bronze, spec).first().fecha is None


@pytest.mark.parametrize("exact", [None, 2])
def test_annual_metrics(spark, rows_of, exact):
    day = date(2021, 1, 1)
    silver = spark.createDataFrame(
        [("a", 2021, day, 1.0), ("a", 2021, day, 2.0), ("b", 2021, day, 5.5), ("b", 2021, None, 9.0)],
        "indicador string, anio int, fecha date, valor double",
    )
    assert rows_of(gold.annual_metrics(silver, exact=exact)) == [
        (2021, "a", 1.5, 1.0, 2.0, 0.71, 2), (2021, "b", 5.5, 5.5, 5.5, None, 1),
    ]


@pytest.mark.parametrize("exact", [None, 2])
def test_top_k_evolution(spark, rows_of, exact):
    silver = spark.createDataFrame(
        [("a", 2021, 5.0), ("a", 2022, 6.0), ("b", 2021, 4.0), ("b", 2021, 7.0), ("c", 2021, 1.0), (None, 2021, 0.5)],
        "g string, anio int, v double",
    )
    totals = gold.yearly_totals(silver, "g", "v", exact)
    assert rows_of(gold.top_k_evolution(totals, "g", 2, "m", "s", exact)) == [
        (2021, "a", 5.0, 5.0, 1), (2021, "b", 5.5, 11.0, 2), (2022, "a", 6.0, 6.0, 1),
    ]
    leaders = [r.g for r in gold.leading_groups(totals, "g", 2).collect()]
    assert leaders == ["a", "b"]  # both sum to 11, the name decides


def test_dashboard_from_one_table_equals_union_of_parts(spark, rows_of):
    rows = spark.createDataFrame(
        [(2021, "h", "x", 1.0), (2021, "m", "x", 2.0), (2021, None, "y", 4.0), (2022, "h", None, 3.0), (2022, "h", "x", None)],
        "anio int, sexo string, nivel string, valor double",
    )
    one = gold.shared_dashboard(rows, {"Sexo": "sexo", "Nivel": "nivel"}, "valor")
    parts = gold.dimension_dashboard([
        gold.Dimension(rows, "Total Nacional"), gold.Dimension(rows, "Sexo", "sexo"),
        gold.Dimension(rows, "Nivel", "nivel"),
    ])
    assert rows_of(one) == rows_of(parts)
    assert (2021, "Total Nacional", "General", 2.33) in rows_of(one)


def test_index_rounds_before_it_halves(spark):
    rows = spark.createDataFrame(
        [(LEVELS.primary, 75.2), (LEVELS.secondary, 70.1), (LEVELS.high, 28.0), ("Media", 1.0)],
        "nivel_educativo string, tasa_informalidad double",
    )
    row = gold.vulnerability_index(rows, LEVELS).first()
    assert tuple(row) == (2.59, 72.5, 28.0)
    without = rows.where(F.col("nivel_educativo") != LEVELS.secondary)
    assert tuple(gold.vulnerability_index(without, LEVELS).first()) == (None, None, 28.0)
    zero = rows.withColumn("tasa_informalidad", F.when(
        F.col("nivel_educativo") == LEVELS.high, 0.0).otherwise(F.col("tasa_informalidad")))
    assert gold.vulnerability_index(zero, LEVELS).first()[0] is None


def test_entity_profile_exclusions(spark, rows_of):
    rows = spark.createDataFrame(
        [("Cali", 2.0), ("Cali", 4.0), ("Concepto", 1.0), ("Unnamed: 2", 1.0), ("23 ciudades y A.M.", 9.0), (None, 1.0), ("Pasto", None)],
        "ciudad string, valor double",
    )
    got = gold.entity_profile(
        rows, exclude_like=("%Concepto%", "%Unnamed%"), exclude_values=("23 ciudades y A.M.",)
    )
    assert rows_of(got) == [("Cali", 3.0, 2.0, 4.0, 2)]


MIXED, TRAINING = "INTERVENCIÓN MIXTA (Formación + Subsidio)", "FORMACIÓN TÉCNICA"
SUBSIDY, WATCH = "SUBSIDIO A CONTRATACIÓN", "MONITOREO"
RULE_CASES = [
    ("a", 1000.01, 0.65, "ALTA", MIXED, "ALTA"), ("b", 1000.0, 0.65, "MEDIA", TRAINING, "MEDIA"),
    ("c", 400.01, 0.64, "MEDIA", WATCH, "MEDIA"), ("d", 1500.0, None, "ALTA", WATCH, "ALTA"),
    ("e", 400.0, 0.10, "BAJA", SUBSIDY, "BAJA"), ("f", None, 0.68, "BAJA", SUBSIDY, "BAJA"),
]
VALUE, INDEX = "tasa_informalidad_promedio_miles", "indice_vulnerabilidad_educativa"


@pytest.fixture(scope="module")
def features(spark):
    df = spark.createDataFrame([c[:3] for c in RULE_CASES], f"ciudad string, {VALUE} double, {INDEX} double")
    return df.withColumn("severidad_informalidad", severity_band(F.col(VALUE)))


def test_rule_cases(features):
    rows = {r.ciudad: r for r in recommend(features).collect()}
    for name, _, _, severity, label, urgency in RULE_CASES:
        row = rows[name]
        assert (row.severidad_informalidad, row.instrumento_recomendado, row.prioridad) == (severity, label, urgency)
    assert rows["f"].justificacion is None and rows["d"].justificacion is None
    assert rows["a"].justificacion == (
        "Ciudad con alta severidad (1000.0 mil informales). Índice vulnerabilidad educativa: 0.65. "
        "Indica que la población con baja educación tiene -35.0% más informalidad que universitarios."
    )


def test_rule_table_equals_rule_chain(spark, features, rows_of):
    extra = (Rule("ALTA", "PRIMERA", 0.7), *default_rules(), Rule("MEDIA", "ÚLTIMA"))
    chain = features.withColumn(
        "instrumento_recomendado", first_match(F.col("severidad_informalidad"), F.col(INDEX), extra)
    )
    table = first_match_by_table(features, rule_table(spark, extra))
    assert rows_of(chain) == rows_of(table)
    assert "Exchange hashpartitioning" not in table._jdf.queryExecution().executedPlan().toString()


def test_priority_order(spark):
    df = spark.createDataFrame([("MEDIA",), ("BAJA",), (None,), ("ALTA",)], "s string")
    ranked = df.select("s", priority(F.col("s")).alias("p"), priority_rank(F.col("s")).alias("r"))
    assert [(r.s, r.p) for r in ranked.orderBy("r").collect()] == [
        ("ALTA", "ALTA"), ("MEDIA", "MEDIA"), ("BAJA", "BAJA"), (None, "BAJA"),
    ]


def test_thresholds_are_parameters(spark):
    row = spark.range(1).select(
        severity_band(F.lit(50.0), Thresholds(40.0, 10.0)).alias("a"),
        severity_band(F.lit(10.0), Thresholds(40.0, 10.0)).alias("b"),
    ).first()
    assert tuple(row) == ("ALTA", "BAJA")


def test_run_metrics(features, rows_of):
    assert rows_of(recommendation_metrics(recommend(features))) == sorted([
        ("ciudades_INTERVENCIÓN_MIXTA_Formación_+_Subsidio", 1.0), ("ciudades_FORMACIÓN_TÉCNICA", 1.0),
        ("ciudades_MONITOREO", 2.0), ("ciudades_SUBSIDIO_A_CONTRATACIÓN", 2.0),
        ("total_ciudades_analizadas", 6.0), ("ciudades_prioridad_alta", 2.0),
        ("promedio_informalidad_miles", 860.0), ("cobertura_poblacion_pct", 100.0),
    ], key=repr)


def test_compare_runs(spark, rows_of):
    records = spark.createDataFrame([("r1", "x", 1.0), ("r1", "y", 2.0), ("r2", "x", 3.0)], "run_id string, clave string, valor double")
    assert rows_of(compare_runs(records, ["x", "y"])) == [("r1", 1.0, 2.0), ("r2", 3.0, None)]


def test_summaries(features, rows_of):
    done = recommend(features)
    assert rows_of(kpis.distribution(done, ["prioridad"], with_mean=True)) == [
        ("ALTA", 2, 2500.0, 1250.0), ("BAJA", 2, 400.0, 400.0), ("MEDIA", 2, 1400.0, 700.0),
    ]
    assert [r.ciudad for r in kpis.executive_top(done, k=2).collect()] == ["d", "a"]
    assert kpis.most_frequent(done, "instrumento_recomendado").first()[0] == WATCH


def test_group_gap(spark):
    df = spark.createDataFrame([("p", 75.0), ("p", 76.0), ("u", 28.0), ("z", 1.0)], "g string, v double")
    assert kpis.group_gap(df, "g", "p", "u", "v").first()[0] == 47.5
