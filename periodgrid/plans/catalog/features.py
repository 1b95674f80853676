"""Entity features, threshold rules, recommendations and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import gold, kpis
from ...operators.quality import counts_by_condition
from ...operators.rule_index import first_match_by_intervals
from ...operators.rules import (
    HIGH,
    LOW,
    MEDIUM,
    MIXED,
    MONITORING,
    REASON_TEXT,
    SUBSIDY,
    TRAINING,
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
from ..runs import compare_runs, recommendation_metrics
from .registry import mean_sql, query, round_sql, sum_sql, table

VALUE = "tasa_informalidad_promedio_miles"
INDEX = "indice_vulnerabilidad_educativa"
BANDS = Thresholds(high=280000.0, medium=220000.0)
LEVELS = gold.EducationLevels("A", "N", "R")


def profile_sql(entity: str, value: str, source: str) -> str:
    return f"""
SELECT {entity} AS ciudad, {mean_sql(value)} AS {VALUE},
       {round_sql(f'min({value})')} AS tasa_informalidad_min,
       {round_sql(f'max({value})')} AS tasa_informalidad_max, count(*) AS num_observaciones
FROM {source} GROUP BY 1"""


INDEX_SQL = f"""
SELECT {round_sql('low / nullif(high, 0)')} AS {INDEX},
       low AS tasa_informalidad_baja_educacion, high AS tasa_informalidad_alta_educacion
FROM (
  SELECT {round_sql("max(CASE WHEN k = 'A' THEN v END) + max(CASE WHEN k = 'N' THEN v END)", 0)} / 2 AS low,
         max(CASE WHEN k = 'R' THEN v END) AS high
  FROM (SELECT l_returnflag AS k, {mean_sql('l_quantity')} AS v
        FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_returnflag) r) t"""


def band_sql(value: str, bands: Thresholds = BANDS) -> str:
    return f"""CASE WHEN {value} > {bands.high} THEN '{HIGH}'
     WHEN {value} > {bands.medium} THEN '{MEDIUM}' ELSE '{LOW}' END"""


def label_sql(severity: str = "severidad_informalidad", index: str = INDEX) -> str:
    return f"""CASE WHEN {severity} = '{HIGH}' AND {index} >= 0.65 THEN '{MIXED}'
     WHEN {severity} = '{MEDIUM}' AND {index} >= 0.65 THEN '{TRAINING}'
     WHEN {severity} = '{LOW}' THEN '{SUBSIDY}' ELSE '{MONITORING}' END"""


T = REASON_TEXT
REASON_SQL = f"""'{T[0]}' || lower(severidad_informalidad) || '{T[1]}' || CAST(round({VALUE}, 0) AS VARCHAR)
  || '{T[2]}' || CAST({INDEX} AS VARCHAR) || '{T[3]}'
  || CAST(round(({INDEX} - 1) * 100, 0) AS VARCHAR) || '{T[4]}'"""

FEATURES_SQL = f"""
WITH prof AS ({profile_sql('o_custkey', 'o_totalprice', 'orders')}),
ve AS ({INDEX_SQL}),
feat AS (SELECT *, {band_sql(VALUE)} AS severidad_informalidad FROM prof CROSS JOIN ve),
rec AS (SELECT *, {label_sql()} AS instrumento_recomendado,
          severidad_informalidad AS prioridad, {REASON_SQL} AS justificacion FROM feat)
"""


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ciudad"), F.col("o_totalprice").alias("valor")
    )
    return gold.entity_profile(orders, exact=2)


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.entity_features(
        customer_profile(spark, sf_dir),
        vulnerability_index(spark, sf_dir),
        severity_band(F.col(VALUE), BANDS),
    )


def customer_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend(customer_features(spark, sf_dir), default_rules(BANDS))


@query(profile_sql(
    "n_name", "c_acctbal",
    """customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT LIKE '%Concepto%' AND n_name NOT LIKE '%N_7' AND n_name <> 'NATION_3'"""))
def entity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation, placeholder names and the aggregate row left out."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    named = rows.select(F.col("n_name").alias("ciudad"), F.col("c_acctbal").alias("valor"))
    return gold.entity_profile(
        named, exclude_like=("%Concepto%", "%N_7"), exclude_values=("NATION_3",), exact=2
    )


@query(INDEX_SQL)
def vulnerability_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return gold.vulnerability_index(lines, LEVELS, "l_returnflag", "l_quantity", exact=2)


@query(FEATURES_SQL + "SELECT * FROM feat")
def profile_cross_single_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_features(spark, sf_dir)


@query(f"""SELECT c_custkey, {band_sql('c_acctbal', Thresholds(5000.0, 1000.0))} AS severidad
FROM customer""")
def severity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = severity_band(F.col("c_acctbal"), Thresholds(5000.0, 1000.0))
    return table(spark, sf_dir, "customer").select("c_custkey", band.alias("severidad"))


# Each customer with an index of its own, so that every rule and the default are reached.
OWN_INDEX_SQL = f"""
WITH prof AS ({profile_sql('o_custkey', 'o_totalprice', 'orders')}),
own AS (SELECT ciudad, {band_sql(VALUE)} AS severidad_informalidad,
          {round_sql('tasa_informalidad_min / nullif(tasa_informalidad_max, 0) * 3')} AS {INDEX}
        FROM prof)
SELECT *, {label_sql()} AS instrumento_recomendado FROM own"""


def own_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.try_divide(F.col("tasa_informalidad_min"), F.col("tasa_informalidad_max")) * 3
    return customer_profile(spark, sf_dir).select(
        "ciudad",
        severity_band(F.col(VALUE), BANDS).alias("severidad_informalidad"),
        F.round(ratio.cast("decimal(38,6)"), 2).cast("double").alias(INDEX),
    )


@query(OWN_INDEX_SQL)
def rule_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = first_match(F.col("severidad_informalidad"), F.col(INDEX), default_rules(BANDS))
    return own_index(spark, sf_dir).withColumn("instrumento_recomendado", label)


@query(OWN_INDEX_SQL)
def rule_table_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rule_table(spark, default_rules(BANDS))
    return first_match_by_table(own_index(spark, sf_dir), rules)


RULES_SQL = """
SELECT s_suppkey AS regla, CASE s_suppkey % 4 WHEN 0 THEN 'ALTA' WHEN 1 THEN 'MEDIA' WHEN 2 THEN 'BAJA' ELSE 'OTRA' END AS severidad,
       CASE WHEN s_suppkey % 50 = 49 THEN NULL ELSE abs(s_acctbal) / 3000 END AS minimo, s_name AS etiqueta FROM supplier"""


@query(f"""
WITH regla AS ({RULES_SQL}), fila AS (SELECT ciudad, severidad_informalidad, {INDEX} FROM ({OWN_INDEX_SQL}) o),
primera AS (SELECT ciudad, min(regla) AS regla FROM fila JOIN regla
            ON severidad = severidad_informalidad AND (minimo IS NULL OR {INDEX} >= minimo) GROUP BY 1)
SELECT f.*, coalesce(r.etiqueta, '{MONITORING}') AS instrumento_recomendado
FROM fila f LEFT JOIN primera p ON p.ciudad = f.ciudad LEFT JOIN regla r ON r.regla = p.regla""")
def rule_index_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per supplier: the first that each customer meets, by intervals and buckets."""
    key = F.col("s_suppkey") % 4
    rules = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("regla"),
        F.when(key == 0, "ALTA").when(key == 1, "MEDIA").when(key == 2, "BAJA").otherwise("OTRA").alias("severidad"),
        F.when(F.col("s_suppkey") % 50 != 49, F.abs("s_acctbal") / 3000).alias("minimo"),
        F.col("s_name").alias("etiqueta"))
    return first_match_by_intervals(own_index(spark, sf_dir), rules)


@query(FEATURES_SQL + "SELECT * FROM rec")
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, instrument, priority and reason of every customer."""
    return customer_recommendations(spark, sf_dir)


@query(FEATURES_SQL + "SELECT ciudad, justificacion FROM rec")
def justification_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_recommendations(spark, sf_dir).select("ciudad", "justificacion")


@query(FEATURES_SQL + f"""
SELECT instrumento_recomendado, count(*) AS num_ciudades, {sum_sql(VALUE, 0)} AS total_informales_miles
FROM rec GROUP BY 1""")
def rule_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpis.distribution(
        customer_recommendations(spark, sf_dir), ["instrumento_recomendado"], exact=2
    )
    return rows.orderBy(F.col("total_informales_miles").desc())


@query(FEATURES_SQL + f"""
SELECT instrumento_recomendado, prioridad, count(*) AS num_ciudades,
       {sum_sql(VALUE, 0)} AS total_informales_miles, {mean_sql(VALUE, 0)} AS promedio_informales_miles
FROM rec GROUP BY 1, 2""")
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpis.distribution(
        customer_recommendations(spark, sf_dir),
        ["instrumento_recomendado", "prioridad"], with_mean=True, exact=2,
    )
    return rows.orderBy(priority_rank(F.col("prioridad")), F.col("total_informales_miles").desc())


def metrics_sql(source: str, run: str = "") -> str:
    pick, group = (f"{run} AS run_id, ", f"{run}, ") if run else ("", "")
    tail = f"GROUP BY {run}" if run else ""
    key = "replace(replace(replace(instrumento_recomendado, ' ', '_'), '(', ''), ')', '')"
    return f"""
SELECT {pick}'ciudades_' || {key} AS metrica, CAST(count(*) AS DOUBLE) AS valor
FROM {source} GROUP BY {group}instrumento_recomendado
UNION ALL SELECT {pick}'total_ciudades_analizadas', CAST(count(*) AS DOUBLE) FROM {source} {tail}
UNION ALL SELECT {pick}'ciudades_prioridad_alta',
  CAST(sum(CASE WHEN prioridad = '{HIGH}' THEN 1 ELSE 0 END) AS DOUBLE) FROM {source} {tail}
UNION ALL SELECT {pick}'promedio_informalidad_miles', {mean_sql(VALUE)} FROM {source} {tail}
UNION ALL SELECT {pick}'cobertura_poblacion_pct', CAST(max(100) AS DOUBLE) FROM {source} {tail}"""


@query(FEATURES_SQL + metrics_sql("rec"))
def run_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommendation_metrics(customer_recommendations(spark, sf_dir), exact=2)


TRIALS = {"estricto": (300000.0, 240000.0), "medio": (280000.0, 220000.0), "amplio": (260000.0, 200000.0)}
TRIALS_SQL = " UNION ALL ".join(
    f"SELECT '{run}' AS run_id, CAST({high} AS DOUBLE) AS alta, CAST({medium} AS DOUBLE) AS media"
    for run, (high, medium) in TRIALS.items()
)
COMPARED = ("total_ciudades_analizadas", "ciudades_prioridad_alta", "ciudades_MONITOREO",
            "ciudades_FORMACIÓN_TÉCNICA", "promedio_informalidad_miles")


@query(f"""
WITH prof AS ({profile_sql('o_custkey', 'o_totalprice', 'orders')}),
trial AS ({TRIALS_SQL}),
feat AS (SELECT *, CASE WHEN {VALUE} > alta THEN '{HIGH}' WHEN {VALUE} > media THEN '{MEDIUM}' ELSE '{LOW}' END
           AS severidad_informalidad,
           {round_sql('tasa_informalidad_min / nullif(tasa_informalidad_max, 0) * 3')} AS {INDEX}
         FROM prof CROSS JOIN trial),
rec AS (SELECT *, {label_sql()} AS instrumento_recomendado, severidad_informalidad AS prioridad FROM feat),
met AS ({metrics_sql('rec', 'run_id')})
SELECT run_id, {', '.join(f'''max(CASE WHEN metrica = '{m}' THEN valor END) AS "{m}"''' for m in COMPARED)}
FROM met GROUP BY run_id""")
def run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three threshold settings side by side; the facts are profiled once for all of them."""
    trials = F.array(*[
        F.struct(F.lit(run).alias("run_id"), F.lit(high).alias("alta"), F.lit(medium).alias("media"))
        for run, (high, medium) in TRIALS.items()
    ])
    ratio = F.try_divide(F.col("tasa_informalidad_min"), F.col("tasa_informalidad_max")) * 3
    features = customer_profile(spark, sf_dir).select("*", F.inline(trials)).select(
        "run_id", VALUE,
        F.when(F.col(VALUE) > F.col("alta"), HIGH).when(F.col(VALUE) > F.col("media"), MEDIUM)
        .otherwise(LOW).alias("severidad_informalidad"),
        F.round(ratio.cast("decimal(38,6)"), 2).cast("double").alias(INDEX),
    )
    severity = F.col("severidad_informalidad")
    chosen = features.select(
        "run_id", VALUE,
        first_match(severity, F.col(INDEX), default_rules()).alias("instrumento_recomendado"),
        priority(severity).alias("prioridad"),
    )
    records = recommendation_metrics(chosen, ["run_id"], exact=2)
    return compare_runs(records.withColumnRenamed("metrica", "clave"), COMPARED)


@query(FEATURES_SQL + f"""
SELECT ciudad, {VALUE}, instrumento_recomendado, prioridad
FROM rec ORDER BY {VALUE} DESC, ciudad LIMIT 10""")
def top10_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.executive_top(customer_recommendations(spark, sf_dir))


RANK_SQL = f"CASE prioridad WHEN '{HIGH}' THEN 1 WHEN '{MEDIUM}' THEN 2 ELSE 3 END"


@query(FEATURES_SQL + f"""
SELECT ciudad, prioridad, CAST({RANK_SQL} AS INTEGER) AS prioridad_rank, {VALUE} FROM rec""")
def priority_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most urgent first: by meaning of the label, not by its spelling."""
    rows = customer_recommendations(spark, sf_dir).select(
        "ciudad", "prioridad", priority_rank(F.col("prioridad")).alias("prioridad_rank"), VALUE
    )
    return rows.orderBy("prioridad_rank", F.col(VALUE).desc(), "ciudad")


@query(FEATURES_SQL + f"""
SELECT 'Ciudades con features' AS metrica, count(*) AS cantidad FROM feat
UNION ALL SELECT 'Severidad alta', count(*) FROM feat WHERE severidad_informalidad = '{HIGH}'
UNION ALL SELECT 'Severidad media', count(*) FROM feat WHERE severidad_informalidad = '{MEDIUM}'""")
def filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.col("severidad_informalidad")
    return counts_by_condition(customer_features(spark, sf_dir), {
        "Ciudades con features": F.lit(True),
        "Severidad alta": severity == HIGH,
        "Severidad media": severity == MEDIUM,
    })


@query(FEATURES_SQL + f"SELECT count(*) AS ciudades_prioridad_alta FROM rec WHERE prioridad = '{HIGH}'")
def high_priority_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_recommendations(spark, sf_dir)
    return rows.agg(F.count_if(F.col("prioridad") == HIGH).alias("ciudades_prioridad_alta"))


@query(FEATURES_SQL + """
SELECT instrumento_recomendado, count(*) AS veces FROM rec GROUP BY 1
ORDER BY veces DESC, instrumento_recomendado LIMIT 1""")
def most_frequent_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.most_frequent(customer_recommendations(spark, sf_dir), "instrumento_recomendado")


@query(FEATURES_SQL + f"""
SELECT ciudad, {VALUE}, prioridad FROM rec WHERE instrumento_recomendado LIKE '%FORMACIÓN%'""")
def like_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-sensitive: finds the training label, not the mixed one that spells it in lower case."""
    rows = customer_recommendations(spark, sf_dir)
    return rows.where(F.col("instrumento_recomendado").like("%FORMACIÓN%")).select(
        "ciudad", VALUE, "prioridad"
    )


@query(FEATURES_SQL + "SELECT * FROM rec WHERE ciudad = 7")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity; the filter reaches the file scan below the aggregation."""
    return customer_recommendations(spark, sf_dir).where(F.col("ciudad") == 7)
