"""Wide sheets to long series, cleaning, yearly metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ...functions.headers import promote_header
from ...functions.numeric import fixed_sum, from_units, units
from ...functions.periods import MONTHS_ES, first_of_month, month_number
from ...functions.text import tolerant_number
from ...operators import gold, reshape
from ...operators.joins import cross_one_row
from ...operators.silver import SilverSpec, clean
from ...session import local_rows
from ...sources.tables import with_lineage
from .registry import (
    FIRST_YEAR,
    GRAMMAR,
    LAST_YEAR,
    mean_sql,
    money_sql,
    month_name,
    month_sql,
    query,
    round_sql,
    table,
    year_of,
    year_sql,
)

YEARS = range(FIRST_YEAR, LAST_YEAR + 1)


def suffix(year: int) -> str:
    return f".{year - FIRST_YEAR}" if year > FIRST_YEAR else ""


MONTH_LABELS = [f"{month}{suffix(year)}" for year in YEARS for month in MONTHS_ES]


def quarter_name(month: int) -> str:
    return f"{MONTHS_ES[month - 1]} - {MONTHS_ES[(month + 1) % 12].lower()}"


QUARTER_LABELS = [f"{quarter_name(m)}{suffix(year)}" for year in YEARS for m in range(1, 13)]


def period_label(date: str, quarter: bool = False) -> Column:
    """The label a sheet gives to the month (or the quarter starting in the month) of a date."""
    names = [quarter_name(m) if quarter else MONTHS_ES[m - 1] for m in range(1, 13)]
    return F.concat(F.element_at(F.array(*[F.lit(n) for n in names]), F.month(date)), year_suffix(F.year(date)))


def year_suffix(year: Column) -> Column:
    """``.<years since FIRST_YEAR>``, nothing for FIRST_YEAR, NULL for NULL.

    The sheets have columns for FIRST_YEAR to LAST_YEAR; a date outside stops the query, so that
    no fact is left out without a word.
    """
    gap = year - FIRST_YEAR
    outside = F.raise_error(F.concat(F.lit(f"no column for a date outside {FIRST_YEAR}-{LAST_YEAR}: "), year.cast("string")))
    return F.when(gap == 0, "").when(year.between(FIRST_YEAR, LAST_YEAR), F.concat(F.lit("."), gap.cast("string"))).when(year.isNotNull(), outside)


def monthly_cells(
    rows: DataFrame, concept: str, date: str, value: str, quarter: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per fact: its concept, its column label and its amount."""
    return rows.select(
        *keep,
        F.col(concept).cast("string").alias("concepto"),
        period_label(date, quarter).alias("etiqueta"),
        F.col(value).alias("importe"),
    )


def wide_sheet(rows: DataFrame, concept: str, date: str, value: str, many: bool = False) -> DataFrame:
    """One row per concept, one text column per month. The labels are known beforehand.

    ``many`` says that the concepts grow with the facts, a few facts to a cell. Summing before the
    shuffle would then keep a cell in memory for nearly each fact of a split, which is as large as
    a row group of the file; the facts are dealt by cell first. A few concepts are summed before.
    """
    cells = monthly_cells(rows, concept, date, value)
    if many:
        cells = cells.repartition("concepto", "etiqueta")
    total = fixed_sum(F.col("importe"), 2).cast("string")
    sums = cells.groupBy("concepto", "etiqueta").agg(total.alias("total"))
    return reshape.spread(sums, "concepto", "etiqueta", "total", MONTH_LABELS)


def orders_sheet(
    spark: SparkSession, sf_dir: str, concept: str = "o_orderpriority", many: bool = False
) -> DataFrame:
    return wide_sheet(table(spark, sf_dir, "orders"), concept, "o_orderdate", "o_totalprice", many)


def long_sql(concept: str, where: str = "") -> str:
    gap = f"year(o_orderdate) - {FIRST_YEAR}"
    month = month_sql("month(o_orderdate)")
    return f"""
SELECT CAST({concept} AS VARCHAR) AS indicador, {year_sql('o_orderdate')} AS anio, {month} AS mes,
       CAST(month(o_orderdate) AS INTEGER) AS mes_num,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
       {month} || CASE WHEN {gap} = 0 THEN '' ELSE '.' || CAST({gap} AS VARCHAR) END AS periodo,
       CAST(sum({money_sql('o_totalprice')}) AS DOUBLE) AS valor
FROM orders {where} GROUP BY ALL"""


@query(long_sql("o_orderpriority"))
def long_from_wide_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.to_long(orders_sheet(spark, sf_dir), "indicador", GRAMMAR)


@query(long_sql("o_custkey"))
def long_from_wide_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet whose number of rows grows with the data."""
    return reshape.to_long(orders_sheet(spark, sf_dir, "o_custkey", many=True), "indicador", GRAMMAR)


@query(long_sql("o_orderpriority", "WHERE year(o_orderdate) <= 1999"))
def long_max_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suffix bound leaves the first five years; the other columns are never read."""
    grammar = replace(GRAMMAR, max_suffix=4)
    return reshape.to_long(orders_sheet(spark, sf_dir), "indicador", grammar)


QUARTER_CASE = " ".join(f"WHEN {m} THEN '{quarter_name(m)}'" for m in range(1, 13))


@query(f"""
WITH m AS (
  SELECT o_orderpriority AS k, year(o_orderdate) AS y, month(o_orderdate) AS m,
         year(o_orderdate) * 12 + month(o_orderdate) AS ym, sum({money_sql('o_totalprice')}) AS v
  FROM orders GROUP BY ALL),
q AS (
  SELECT k, y, m,
    sum(v) OVER (PARTITION BY k ORDER BY ym RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING) AS v
  FROM m)
SELECT k AS indicador, CAST(y AS INTEGER) AS anio, {month_sql('m')} AS mes,
       CAST(m AS INTEGER) AS mes_num, make_date(y, m, 1) AS fecha,
       CASE m {QUARTER_CASE} END
         || CASE WHEN y = {FIRST_YEAR} THEN '' ELSE '.' || CAST(y - {FIRST_YEAR} AS VARCHAR) END AS periodo,
       CAST(v AS DOUBLE) AS valor
FROM q""")
def long_quarter_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving quarters are dated at their first month and know no suffix bound."""
    date = F.col("o_orderdate")
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("concepto"),
            F.year(date).alias("y"),
            F.month(date).alias("m"),
        )
        .agg(fixed_sum(F.col("o_totalprice"), 2).alias("v"))
        .withColumn("ym", F.col("y") * 12 + F.col("m"))
    )
    # Months of one concept: as many as the calendar has.
    ahead = Window.partitionBy("concepto").orderBy("ym").rangeBetween(0, 2)
    names = F.array(*[F.lit(quarter_name(m)) for m in range(1, 13)])
    tail = year_suffix(F.col("y"))
    sheet = (
        monthly.select(
            "concepto",
            F.concat(F.element_at(names, F.col("m")), tail).alias("etiqueta"),
            F.sum("v").over(ahead).alias("v"),
        )
        .groupBy("concepto")
        .pivot("etiqueta", QUARTER_LABELS)
        .agg(F.first("v"))
    )
    return reshape.to_long(sheet, "indicador", replace(GRAMMAR, max_suffix=4))


def repeated_header(spark: SparkSession, sf_dir: str, concept: str, many: bool = False) -> DataFrame:
    """Headed rows of a sheet that repeats ``Ene .. Dic`` without any suffix."""
    sheet = orders_sheet(spark, sf_dir, concept, many)
    names = ["", *(month for _ in YEARS for month in MONTHS_ES)]
    cells = F.array(*[F.col(f"`{name}`") for name in sheet.columns])
    # The header is worked out once, as a relation of one row, not once per line.
    line = local_rows(spark, ("linea",), [(",".join(names),)])
    header = promote_header(line, F.split("linea", ","), GRAMMAR)
    return cross_one_row(sheet.select(cells.alias("celdas")), header)


@query(long_sql("o_custkey"))
def grid_header_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated labels are told apart by position and give the same series."""
    long = reshape.headed_rows_to_long(repeated_header(spark, sf_dir, "o_custkey", many=True))
    return long.withColumnRenamed("concepto", "indicador")


# -- cells and labels ---------------------------------------------------------------------

@query("""
SELECT event_id, CASE event_id % 10
         WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)
         WHEN 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)
         WHEN 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)
         WHEN 3 THEN CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS DOUBLE) END AS valor
FROM events""", name="tolerant_number")
def parse_spoilt_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event carries its value as text, in ten spellings; six of them are no number."""
    text = F.col("value").cast("decimal(18,2)").cast("string")
    form = F.col("event_id") % 10
    dirty = (
        F.when(form == 0, text)
        .when(form == 1, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(form == 2, F.concat(F.lit("+"), text))
        .when(form == 3, F.concat(text, F.lit("e3")))
        .when(form == 4, F.concat(text, F.lit("*")))
        .when(form == 5, F.concat(text, F.lit("d")))
        .when(form == 6, F.concat(F.lit("1,"), text))
        .when(form == 7, F.lit("-"))
        .when(form == 8, F.lit(""))
        .otherwise(F.lit("NaN"))
    )
    return table(spark, sf_dir, "events").select("event_id", tolerant_number(dirty).alias("valor"))


@query(f"""
SELECT o_orderkey, {year_sql('o_orderdate')} AS anio, {month_sql('month(o_orderdate)')} AS mes,
       CAST(month(o_orderdate) AS INTEGER) AS mes_num,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha FROM orders""")
def month_map_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey", year_of("o_orderdate").alias("anio"),
        month_name(F.month("o_orderdate")).alias("mes"),
    )
    number = month_number(F.col("mes"))
    return named.select("*", number.alias("mes_num"), first_of_month(F.col("anio"), number).alias("fecha"))


# -- cleaning -----------------------------------------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS indicador,
       {year_sql('l_shipdate')} AS anio, {month_sql('month(l_shipdate)')} AS mes,
       CAST(month(l_shipdate) AS INTEGER) AS mes_num,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha,
       CAST(round({money_sql('l_extendedprice')} * (1 - {money_sql('l_discount')}), 2) AS DOUBLE) AS valor
FROM lineitem WHERE l_linestatus <> 'F' AND month(l_shipdate) <> 2""")
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded concepts, values with four decimals, starred and missing months."""
    date = F.col("l_shipdate")
    month = month_name(F.month(date))
    price, discount = units(F.col("l_extendedprice"), 2), units(F.col("l_discount"), 2)
    net = from_units(price * (100 - discount), 4)
    bronze = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")).alias("indicador"),
        year_of("l_shipdate").alias("anio"),
        F.when(F.month(date) == 2, F.concat(month, F.lit("*"))).otherwise(month).alias("mes"),
        F.month(date).alias("mes_num"),
        F.when(F.col("l_linestatus") != "F", net).alias("valor"),
    )
    spec = SilverSpec("indicador", lineage=LINE_KEYS, named_months=True, exact=4)
    return clean(bronze, spec)


@query(f"""
SELECT o_orderkey, trim(v) AS rama_actividad, {year_sql('o_orderdate')} AS anio,
       CAST({money_sql('o_totalprice')} AS DOUBLE) AS ocupados_miles
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN ' ' || o_orderpriority ELSE o_orderpriority END AS v
      FROM orders) WHERE v <> '4-NOT SPECIFIED'""")
def silver_exclude_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The excluded value is compared before trimming, so its padded spelling stays."""
    padded = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit(" "), F.col("o_orderpriority"))
    ).otherwise(F.col("o_orderpriority"))
    bronze = table(spark, sf_dir, "orders").select(
        "o_orderkey", padded.alias("rama_actividad"), year_of("o_orderdate").alias("anio"),
        F.col("o_totalprice").alias("valor"),
    )
    spec = SilverSpec(
        "rama_actividad", "ocupados_miles", ("anio",), ("o_orderkey",), ("4-NOT SPECIFIED",), exact=2
    )
    return clean(bronze, spec)


@query(f"""
SELECT o_orderkey, o_orderpriority AS ciudad, {year_sql('o_orderdate')} AS anio,
       CAST(1 + o_orderkey % 14 AS INTEGER) AS mes_num,
       CASE WHEN 1 + o_orderkey % 14 BETWEEN 1 AND 12
            THEN make_date(year(o_orderdate), 1 + o_orderkey % 14, 1) END AS fecha,
       CAST({money_sql('o_totalprice')} AS DOUBLE) AS tasa_informalidad FROM orders""")
def silver_guarded_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month beyond 12 gives no date instead of an error."""
    bronze = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("ciudad"), year_of("o_orderdate").alias("anio"),
        (1 + F.col("o_orderkey") % 14).cast("int").alias("mes_num"),
        F.col("o_totalprice").alias("valor"),
    )
    columns = ("anio", "mes_num", "fecha")
    spec = SilverSpec("ciudad", "tasa_informalidad", columns, ("o_orderkey",), exact=2)
    return clean(bronze, spec)


@query("""
SELECT o_orderkey, 'orders.parquet' AS _archivo_origen, 'orders' AS _hoja_origen,
       true AS _cargado FROM orders""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("_metadata.file_name").alias("_file")
    )
    traced = with_lineage(orders, F.col("_file"), F.lit("orders")).drop("_file")
    return traced.withColumn("_cargado", F.col("_fecha_carga").isNotNull()).drop("_fecha_carga")


# -- yearly metrics -----------------------------------------------------------------------

@query(f"""
WITH m AS ({long_sql('o_orderpriority')})
SELECT anio, indicador, {mean_sql('valor')} AS promedio_anual, {round_sql('min(valor)')} AS valor_minimo,
       {round_sql('max(valor)')} AS valor_maximo, {round_sql('stddev_samp(valor)')} AS desviacion_estandar,
       count(*) AS num_observaciones
FROM m GROUP BY anio, indicador""")
def annual_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet -> long -> cleaned -> yearly metrics."""
    bronze = long_from_wide_months(spark, sf_dir)
    spec = SilverSpec("indicador", lineage=(), named_months=True, exact=2)
    return gold.annual_metrics(clean(bronze, spec), exact=2)


@query(f"""
SELECT {year_sql('o_orderdate')} AS anio, CAST(o_custkey AS VARCHAR) AS indicador,
       {mean_sql('o_totalprice')} AS promedio_anual, {round_sql('min(o_totalprice)')} AS valor_minimo,
       {round_sql('max(o_totalprice)')} AS valor_maximo,
       {round_sql('stddev_samp(o_totalprice)')} AS desviacion_estandar, count(*) AS num_observaciones
FROM orders GROUP BY ALL""")
def annual_metrics_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same metrics straight from long rows, for as many concepts as there are customers."""
    long = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("indicador"),
        year_of("o_orderdate").alias("anio"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("valor"),
    )
    return gold.annual_metrics(long, exact=2)
