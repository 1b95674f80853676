"""The label grammar, header names and the numeric parse, case by case and by property."""

import io
import math
from datetime import date

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from periodgrid.functions.headers import fill_blank_labels, number_repeats, promote_header
from periodgrid.functions.periods import (
    MONTHS_ES,
    PeriodGrammar,
    month_number,
    period_date,
    period_is_valid,
    period_month,
    period_suffix,
    period_year,
)
from periodgrid.functions.text import metric_key, na_to_null, strip_ws, tolerant_number
from periodgrid.operators.reshape import label_frame, read_labels

CASES = [
    ("Ene", True, 1, 2021), ("Ene.1", True, 1, 2022), ("Ene.4", True, 1, 2025),
    ("Ene.5", False, 1, 2026), ("Abr*", True, 4, 2021), ("Abr*.1", True, 4, 2022),
    ("Abr.1*", True, 4, 2021), ("Ene - mar", True, 1, 2021), ("Ene - mar.1", True, 1, 2022),
    ("Ene - mar.7", True, 1, 2028), ("Nov - ene.2", True, 11, 2023), ("Mayo", False, 5, 2021),
    ("Sept", False, 9, 2021), ("ene", False, None, 2021), ("Unnamed: 26", False, None, 2021),
    ("Concepto", False, None, 2021), ("_hoja_origen", False, None, 2021), ("Ene.04", True, 1, 2025),
    ("Ene -mar", False, 1, 2021), ("Ene.99999999999", False, 1, None), ("", False, None, 2021),
]


def parsed(spark, labels, grammar=PeriodGrammar()):
    label = F.col("etiqueta")
    year, month = period_year(label, grammar), month_number(period_month(label, grammar), grammar)
    rows = label_frame(spark, labels).select(
        "posicion", period_is_valid(label, grammar).alias("ok"), month.alias("month"),
        year.alias("year"), period_suffix(label, grammar).alias("suffix"),
        period_date(year, month).alias("date"),
    ).collect()
    return sorted(rows, key=lambda row: row.posicion)


def test_label_cases(spark):
    rows = parsed(spark, [label for label, *_ in CASES])
    assert [(r.ok, r.month, r.year) for r in rows] == [tuple(case[1:]) for case in CASES]
    assert rows[0].date == date(2021, 1, 1) and rows[10].date == date(2023, 11, 1)


def test_star_suffix_switch(spark):
    fixed = parsed(spark, ["Abr.1*"], PeriodGrammar(fix_star_suffix=True))[0]
    assert fixed.year == 2022


def test_date_only_inside_the_timestamp_range(spark):
    rows = parsed(spark, ["Ene - mar.241", "Abr - jun.241", "May - jul.241", "Ene - mar.300"])
    assert [r.date for r in rows] == [date(2262, 1, 1), date(2262, 4, 1), None, None]


def test_null_label_is_no_period(spark):
    row = spark.range(1).select(period_is_valid(F.lit(None).cast("string")).alias("ok")).first()
    assert row.ok is False


# What stands after a month: text, what makes it a period (ALWAYS, NEVER or the number that the
# bound is held against), and the suffix that the whole label carries.
ALWAYS, NEVER = "always", "never"
TAILS = [
    ("", ALWAYS, 0), ("*", ALWAYS, 0), (" - mar", ALWAYS, 0), (" - mar*", ALWAYS, 0),
    (" - mar.3", ALWAYS, 3), (" - mar.12", ALWAYS, 12), (" - mar.1*", ALWAYS, 0),
    (".0", 0, 0), (".3", 3, 3), (".4", 4, 4), (".5", 5, 5), (".12", 12, 12), (".007", 7, 7),
    ("*.3", 3, 3), (".1*", 1, 0), (" -mar", NEVER, 0), (" -mar.4", NEVER, 4), (" - ", NEVER, 0),
    (".", NEVER, 0), ("..5", NEVER, 5), (" - .3", NEVER, 3),
]
# What stands before it: text, month number, whether a tail can make it a period.
HEADS = [(month, number, True) for number, month in enumerate(MONTHS_ES, 1)] + [
    ("Mayo", 5, False), ("Enero", 1, False), ("ene", None, False), ("Total", None, False), ("", None, False),
]
PARTS = st.lists(st.tuples(st.sampled_from(HEADS), st.sampled_from(TAILS)), min_size=1, max_size=30)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=PARTS, bound=st.integers(0, 6))
def test_labels_by_their_parts(spark, parts, bound):
    rows = parsed(spark, [head[0] + tail[0] for head, tail in parts], PeriodGrammar(max_suffix=bound))
    for row, ((_, month, sound), (_, period, suffix)) in zip(rows, parts, strict=True):
        counts = period == ALWAYS or (period != NEVER and period <= bound)
        assert (row.ok, row.month, row.suffix) == (sound and counts, month, suffix)


def test_reading_labels_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    rows = read_labels(spark, [f"Ene.{i}" for i in range(40)])
    assert [r.posicion for r in rows] == [0, 1, 2, 3, 4]
    assert tracker.getJobIdsForGroup(None) == before


HEADERS = [
    ["k", "Ene", "Feb", "Ene", "Feb", "Ene"], ["k", "Ene", "Ene.1", "Ene"],
    ["k", "Ene", "Ene", "Ene.1"], ["", "Ene ", "Ene", "", ""], ["Ene", "Ene", "Ene.01", "Ene"],
    ["a", "a", "a.1", "a.1", "a.2"],
]


def numbered(spark, header):
    df = spark.createDataFrame([(header,)], "h array<string>")
    return df.select(number_repeats(fill_blank_labels(F.col("h"))).alias("h")).first().h


@pytest.mark.parametrize("header", HEADERS)
def test_header_names_as_a_spreadsheet_reader_gives_them(spark, header):
    assert numbered(spark, header) == list(pd.read_csv(io.StringIO(",".join(header) + "\n")).columns)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(header=st.lists(st.sampled_from(["a", "b", "a.1", "a.2", "b.1"]), min_size=2, max_size=9))
def test_any_header(spark, header):
    assert numbered(spark, header) == list(pd.read_csv(io.StringIO(",".join(header) + "\n")).columns)


def test_promoted_header_trims_after_numbering(spark):
    df = spark.createDataFrame([(["", "Ene ", "Ene", "Ene"],)], "h array<string>")
    row = promote_header(df, F.col("h")).first()
    assert row.etiquetas == ["Unnamed: 0", "Ene", "Ene", "Ene.1"]
    assert [p.anio if p else None for p in row.periodos] == [None, 2021, 2021, 2022]


NUMBERS = [
    "12.5", " 12.5 ", "1e3", "+5", "12.", ".5", "-3", "-", "", "1,234", "12.5*", "True", "0x10",
    "1.0d", "1f", "1_000", "NaN", "inf", "-Infinity", "1e", "e3", "1 2", "1E+02", "N/A", "0x1p3",
]


def test_tolerant_number_cases(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(NUMBERS)], "i int, t string")
    got = {r.i: r.n for r in rows.select("i", tolerant_number(F.col("t")).alias("n")).collect()}
    expected = pd.to_numeric(pd.Series(NUMBERS), errors="coerce")
    for i, want in enumerate(expected):
        text = NUMBERS[i]
        assert (got[i] is None) if math.isnan(want) else (got[i] == want), text


def test_small_text_helpers(spark):
    row = spark.range(1).select(
        strip_ws(F.lit("\t Ene  ")).alias("a"),
        na_to_null(F.lit("N/A")).alias("b"),
        na_to_null(F.lit("x")).alias("c"),
        metric_key(F.lit("INTERVENCIÓN MIXTA (Formación + Subsidio)")).alias("d"),
    ).first()
    assert (row.a, row.b, row.c) == ("Ene", None, "x")
    assert row.d == "INTERVENCIÓN_MIXTA_Formación_+_Subsidio"
