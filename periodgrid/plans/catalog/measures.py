"""Top-k evolution, dashboards and dashboard measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ...functions.numeric import partial_sum, round_result, rounded_mean, units, units_sum
from ...operators import gold, kpis, ranking
from .registry import mean_sql, money_sql, query, round_sql, sum_sql, table, year_of, year_sql


def brand_totals(spark: SparkSession, sf_dir: str, brands: Sequence[str] = ()) -> DataFrame:
    """Yearly quantities per brand; with ``brands``, only lines of their parts are grouped.

    Lines fold to (part, year) before they meet the parts, so a part that holds a third of all
    lines is one row per year when it is joined.
    """
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    if brands:
        parts = parts.where(F.col("p_brand").isin(*brands))
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    by_part = lines.groupBy("l_partkey", year_of("l_shipdate").alias("anio")).agg(
        partial_sum(F.col("l_quantity"), 2).alias("_total"),
        F.count("l_quantity").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
    )
    joined = by_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("anio", "p_brand").agg(
        *[F.sum(name).alias(name) for name in ("_total", "_n", "_rows")]
    )


BRAND_LINES_SQL = "lineitem JOIN part ON l_partkey = p_partkey"
TOP_SQL = f"""
SELECT p_brand, sum({money_sql('l_quantity')}) AS t FROM {BRAND_LINES_SQL}
GROUP BY p_brand ORDER BY t DESC, p_brand LIMIT 10"""


@query(f"SELECT p_brand, CAST(t AS DOUBLE) AS total FROM ({TOP_SQL}) r")
def top_k_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaders = gold.leading_groups(brand_totals(spark, sf_dir), "p_brand")
    return leaders.select("p_brand", F.col("total").cast("double").alias("total"))


@query(f"""
SELECT {year_sql('l_shipdate')} AS anio, l.p_brand, {mean_sql('l_quantity')} AS promedio_ocupados_miles,
       {sum_sql('l_quantity')} AS total_ocupados_miles, count(*) AS num_observaciones
FROM (SELECT * FROM {BRAND_LINES_SQL}) l JOIN ({TOP_SQL}) r ON l.p_brand = r.p_brand
GROUP BY 1, 2""")
def top_k_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_k_evolution(brand_totals(spark, sf_dir), "p_brand", exact=2)


@query(f"""
SELECT anio, p_brand, total_ocupados_miles FROM (
  SELECT {year_sql('l_shipdate')} AS anio, p_brand, {sum_sql('l_quantity')} AS total_ocupados_miles
  FROM {BRAND_LINES_SQL} GROUP BY 1, 2) t
WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23')""")
def in_list_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evolution of named groups."""
    rows = brand_totals(spark, sf_dir, ("Brand#1", "Brand#12", "Brand#23"))
    total = F.round("_total", 2).cast("double").alias("total_ocupados_miles")
    return rows.select("anio", "p_brand", total).orderBy(
        F.col("anio").desc(), F.col("total_ocupados_miles").desc()
    )


RATE = "tasa_informalidad_promedio"
ORDER_YEAR = year_sql("o_orderdate")


def order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        year_of("o_orderdate").alias("anio"), "o_orderstatus", "o_orderpriority",
        F.col("o_totalprice").alias("valor"),
    )


DASHBOARD_SQL = f"""
SELECT {ORDER_YEAR} AS anio, 'Total Nacional' AS dimension, 'General' AS categoria,
       {mean_sql('o_totalprice')} AS {RATE} FROM orders GROUP BY 1
UNION ALL SELECT {ORDER_YEAR}, 'Estado', o_orderstatus, {mean_sql('o_totalprice')} FROM orders GROUP BY 1, 3
UNION ALL SELECT {ORDER_YEAR}, 'Prioridad', o_orderpriority, {mean_sql('o_totalprice')} FROM orders GROUP BY 1, 3"""


@query(DASHBOARD_SQL)
def dimension_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions from one scan of one table."""
    dimensions = {"Estado": "o_orderstatus", "Prioridad": "o_orderpriority"}
    return gold.shared_dashboard(order_values(spark, sf_dir), dimensions, "valor", exact=2)


@query(f"""
SELECT {ORDER_YEAR} AS anio, 'Total Nacional' AS dimension, 'General' AS categoria,
       {mean_sql('o_totalprice')} AS {RATE} FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1
UNION ALL SELECT {year_sql('l_shipdate')}, 'Bandera', l_returnflag, {mean_sql('l_extendedprice')}
FROM lineitem GROUP BY 1, 3
UNION ALL SELECT {year_sql('ts')}, 'Evento', event_type, {mean_sql('value')} FROM events GROUP BY 1, 3""")
def dimension_dashboard_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each dimension from a table of its own, as UNION ALL."""
    national = order_values(spark, sf_dir).where(F.col("o_orderpriority") != "5-LOW")
    lines = table(spark, sf_dir, "lineitem").select(
        year_of("l_shipdate").alias("anio"), "l_returnflag", F.col("l_extendedprice").alias("valor")
    )
    events = table(spark, sf_dir, "events").select(
        year_of("ts").alias("anio"), "event_type", F.col("value").alias("valor")
    )
    return gold.dimension_dashboard([
        gold.Dimension(national, "Total Nacional"),
        gold.Dimension(lines, "Bandera", "l_returnflag"),
        gold.Dimension(events, "Evento", "event_type"),
    ], exact=2)


@query(f"SELECT {ORDER_YEAR} AS anio, {mean_sql('o_totalprice')} AS tasa FROM orders GROUP BY 1")
def overall_rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.rate_by_year(order_values(spark, sf_dir), "valor", exact=2)


@query(f"""
SELECT l_returnflag, l_linestatus, {sum_sql('l_extendedprice')} AS volumen FROM lineitem GROUP BY 1, 2""")
def volume_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return kpis.volume_by_group(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", exact=2)


def flag_mean(flag: str) -> str:
    return mean_sql(f"CASE WHEN l_returnflag = '{flag}' THEN l_extendedprice END")


@query(f"""
SELECT {year_sql('l_shipdate')} AS anio, {round_sql(f"{flag_mean('A')} - {flag_mean('R')}")} AS brecha_pp
FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1""")
def group_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("anio", year_of("l_shipdate"))
    return kpis.group_gap(lines, "l_returnflag", "A", "R", "l_extendedprice", ["anio"], exact=2)


@query(f"""
SELECT o_custkey, anio, valor, {round_sql('valor - lag(valor) OVER (PARTITION BY o_custkey ORDER BY anio)')}
         AS variacion_pp
FROM (SELECT o_custkey, {ORDER_YEAR} AS anio, {mean_sql('o_totalprice')} AS valor
      FROM orders GROUP BY 1, 2) t""")
def pp_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change against the previous year of each customer."""
    yearly = table(spark, sf_dir, "orders").groupBy("o_custkey", year_of("o_orderdate").alias("anio")).agg(
        rounded_mean(F.col("o_totalprice"), 2, 2).alias("valor")
    )
    changed = ranking.lag_change(yearly, "valor", "anio", ["o_custkey"])
    return changed.withColumn("variacion_pp", round_result(F.col("variacion_pp"), 2, 2))


NET_SQL = f"{money_sql('l_extendedprice')} * (1 - {money_sql('l_discount')})"


def net_sum() -> Column:
    """Discounted price, added up in units of 10^-4."""
    price, discount = units(F.col("l_extendedprice"), 2), units(F.col("l_discount"), 2)
    return units_sum(price * (100 - discount), 4)


@query(f"""
WITH t AS (SELECT {year_sql('l_shipdate')} AS anio, p_type, sum({NET_SQL}) AS v
           FROM {BRAND_LINES_SQL} GROUP BY 1, 2)
SELECT anio, p_type, CAST(v AS DOUBLE) AS ingreso,
       {round_sql('CAST(v AS DOUBLE) * 100 / CAST(sum(v) OVER (PARTITION BY anio) AS DOUBLE)', 4)} AS participacion_pct
FROM t""")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_part = table(spark, sf_dir, "lineitem").groupBy(
        "l_partkey", year_of("l_shipdate").alias("anio")
    ).agg(net_sum().alias("v"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    by_type = by_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("anio", "p_type").agg(
        F.sum("v").alias("ingreso")
    )
    shares = ranking.share_of_total(by_type, "ingreso", ["anio"])
    return shares.select(
        "anio", "p_type", F.col("ingreso").cast("double").alias("ingreso"),
        round_result(F.col("participacion_pct"), 4, 2).alias("participacion_pct"),
    )


@query(f"""
SELECT l_suppkey, ingreso, rank() OVER (ORDER BY ingreso DESC) AS puesto
FROM (SELECT l_suppkey, CAST(round(sum({NET_SQL}), 0) AS DOUBLE) AS ingreso FROM lineitem GROUP BY 1) t""")
def rank_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every supplier by revenue, computed in value buckets."""
    revenue = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(net_sum(), 0).cast("double").alias("ingreso")
    )
    return ranking.rank_descending(revenue, "ingreso")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       rank() OVER (ORDER BY l_quantity DESC) AS puesto FROM lineitem""")
def rank_hot_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every line by a value that few distinct numbers share."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return ranking.rank_descending(lines, "l_quantity")
