"""Inventories, quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.numeric import units
from ...operators import profile, quality, sketches
from ...session import cut_lineage
from .registry import query, round_sql, table, year_of

COUNTED = (("BASE", "region"), ("BASE", "nation"), ("ENTIDAD", "customer"), ("HECHO", "orders"), ("HECHO", "lineitem"))
LAYER_NAMES = ("HECHO", "ENTIDAD", "BASE")
INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT '{layer}' AS capa, '{name}' AS tabla, count(*) AS num_filas FROM {name}"
    for layer, name in COUNTED
)


def counted_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.inventory([(layer, name, table(spark, sf_dir, name)) for layer, name in COUNTED])


@query(f"""
SELECT *, CAST(CASE capa WHEN 'HECHO' THEN 1 WHEN 'ENTIDAD' THEN 2 ELSE 3 END AS INTEGER) AS orden
FROM ({INVENTORY_SQL}) t""")
def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = counted_tables(spark, sf_dir)
    ranked = rows.withColumn("orden", quality.layer_order(F.col("capa"), LAYER_NAMES))
    return ranked.orderBy("orden", "tabla")


@query(f"SELECT *, num_filas > 0 AS no_vacia FROM ({INVENTORY_SQL}) t")
def non_empty_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.non_empty(counted_tables(spark, sf_dir))


@query(f"""
SELECT l_returnflag AS tabla, count(*) AS filas_antes,
       CAST(sum(CASE WHEN l_discount BETWEEN 0.02 AND 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS filas_despues,
       CAST(sum(CASE WHEN l_discount BETWEEN 0.02 AND 0.08 THEN 0 ELSE 1 END) AS BIGINT) AS filas_perdidas,
       {round_sql('CAST(sum(CASE WHEN l_discount BETWEEN 0.02 AND 0.08 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*)')}
         AS retencion_pct
FROM lineitem GROUP BY 1""")
def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after a cleaning step, per flag."""
    lines = table(spark, sf_dir, "lineitem")
    kept = lines.where(units(F.col("l_discount"), 2).between(2, 8))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("l_returnflag").alias("tabla")).agg(
            F.count(F.lit(1)).alias("num_filas")
        )

    return quality.retention(counted(lines), counted(kept))


@query("""
SELECT 'l_quantity' AS columna, CAST(sum(CASE WHEN l_quantity BETWEEN 1 AND 45 THEN 0 ELSE 1 END) AS BIGINT)
         AS fuera_de_rango FROM lineitem
UNION ALL SELECT 'l_extendedprice', CAST(sum(CASE WHEN l_extendedprice BETWEEN 1000 AND 90000 THEN 0 ELSE 1 END) AS BIGINT)
FROM lineitem
UNION ALL SELECT 'l_tax', CAST(sum(CASE WHEN l_tax BETWEEN 0 AND 1 THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem""")
def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_check(table(spark, sf_dir, "lineitem"), {
        "l_quantity": (1.0, 45.0), "l_extendedprice": (1000.0, 90000.0), "l_tax": (0.0, 1.0),
    })


@query(f"""
SELECT e.event_id, e.event_type, e.value, {round_sql('(e.value - s.m) / s.d')} AS z
FROM events e JOIN (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1) s
  ON e.event_type = s.event_type
WHERE abs((e.value - s.m) / s.d) > 2""")
def outlier_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events far from the mean of their type; types are few, so each one is hot."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    found = quality.outliers(events, ["event_type"], "value", 2.0)
    return found.withColumn("z", F.round(F.col("z").cast("decimal(38,6)"), 2).cast("double"))


@query("""
WITH m AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS f FROM orders),
span AS (SELECT o_custkey, min(f) AS a, max(f) AS b FROM m GROUP BY 1),
want AS (SELECT o_custkey, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS f
         FROM span)
SELECT w.o_custkey, w.f AS mes_faltante FROM want w
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.o_custkey = w.o_custkey AND m.f = w.f)""")
def completeness_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without an order between the first and the last order of a customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("fecha"))
    return quality.missing_months(orders, ["o_custkey"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS veces FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query("""
SELECT 'event_id' AS columna, count(*) - count(event_id) AS nulos FROM events
UNION ALL SELECT 'ts', count(*) - count(ts) FROM events
UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM events
UNION ALL SELECT 'event_type', count(*) - count(nullif(event_type, 'error')) FROM events
UNION ALL SELECT 'value', count(*) - count(CASE WHEN value < 10 THEN value END) FROM events
UNION ALL SELECT 'props', count(*) - count(props) FROM events""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls per column in one pass; error events and large values count as missing."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") < 10, F.col("value")).alias("value"),
        "props",
    )
    return profile.null_counts(events)


@query("""
SELECT 'p_brand' AS columna, count(DISTINCT p_brand) AS distintos FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part
UNION ALL SELECT 'p_partkey', count(DISTINCT p_partkey) FROM part""")
def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(
        table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name", "p_partkey"]
    )


SKETCHED = (("o_custkey", 0.02), ("o_orderpriority", 0.0))


@query(" UNION ALL ".join(f"""
SELECT '{column}' AS columna, CAST(year(o_orderdate) AS INTEGER) AS anio, count(DISTINCT {column}) AS exactos, true AS cercanos FROM orders GROUP BY 2
UNION ALL SELECT '{column}', NULL, count(DISTINCT {column}), true FROM orders""" for column, _ in SKETCHED))
def distinct_by_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per year and over all years: the years' stored sketches are united, and their
    estimates stand within 2 % of the exact counts (columns of a few values: on them)."""
    orders = table(spark, sf_dir, "orders").withColumn("anio", year_of("o_orderdate"))
    parts = []
    for column, error in SKETCHED:
        yearly = cut_lineage(sketches.distinct_sketches(orders, ("anio",), column))
        total = sketches.united(yearly).select(F.lit(None).cast("int").alias("anio"), "boceto")
        guessed = sketches.estimated(yearly.unionByName(total))
        counted = orders.groupBy("anio").agg(F.count_distinct(column).alias("exactos")).unionByName(
            orders.agg(F.count_distinct(column).alias("exactos")).select(F.lit(None).cast("int").alias("anio"), "exactos"))
        both = guessed.join(counted.withColumnRenamed("anio", "_anio"), F.col("anio").eqNullSafe(F.col("_anio")))
        near = F.abs(F.col("distintos") - F.col("exactos")) <= F.col("exactos") * error
        parts.append(both.select(F.lit(column).alias("columna"), "anio", "exactos", near.alias("cercanos")))
    return parts[0].unionByName(parts[1])


@query("""
SELECT CAST(min(l_shipdate) AS DATE) AS minimo, CAST(max(l_shipdate) AS DATE) AS maximo,
       count(*) AS filas FROM lineitem""")
def range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("fecha"))
    return profile.value_range(lines, "fecha", rows="filas")


@query("""
SELECT user_id, min(event_id) AS primera FROM events GROUP BY user_id ORDER BY primera LIMIT 10""")
def first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.first_values(table(spark, sf_dir, "events"), "user_id", ["event_id"])


@query("""
SELECT 'events' AS tabla, count(*) AS filas, CAST(6 AS INTEGER) AS columnas FROM events
UNION ALL SELECT 'orders', count(*), 6 FROM orders
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem""")
def shape_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("events", "orders", "lineitem")
    shapes = [profile.shape(table(spark, sf_dir, name), name) for name in names]
    return shapes[0].unionByName(shapes[1]).unionByName(shapes[2])


@query("""
SELECT 'bigint' AS tipo, CAST(3 AS INTEGER) AS columnas,
       count(l_orderkey) + count(l_partkey) + count(l_suppkey) AS celdas FROM lineitem
UNION ALL SELECT 'int', 1, count(l_linenumber) FROM lineitem
UNION ALL SELECT 'double', 4, count(l_quantity) + count(l_extendedprice) + count(l_discount) + count(l_tax) FROM lineitem
UNION ALL SELECT 'string', 2, count(l_returnflag) + count(l_linestatus) FROM lineitem
UNION ALL SELECT 'timestamp_ntz', 1, count(l_shipdate) FROM lineitem""")
def dtype_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.type_histogram(table(spark, sf_dir, "lineitem"))
