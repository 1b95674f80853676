"""Run records: parameters and metrics of each run, in two tables with a partition per run.

A run that is repeated under its id replaces its record; other runs are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import mean_of, partial_sum
from ..functions.text import metric_key
from ..operators.rules import HIGH
from ..session import local_rows
from ..sources.tables import TableStore

# Fixed value: all main cities are covered by construction.
COVERAGE_PCT = 100.0


def recommendation_metrics(
    recommendations: DataFrame, by: Sequence[str] = (), exact: int | None = None
) -> DataFrame:
    """``metrica, valor``: entities per instrument, total, high priority, mean, coverage.

    One scan: the rows fold into one line per instrument, from which all metrics follow. The
    lists hold one item per instrument, as many as there are rule labels.
    """
    value = F.col("tasa_informalidad_promedio_miles")
    lines = recommendations.groupBy(*by, "instrumento_recomendado").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("prioridad") == HIGH).alias("_high"),
        partial_sum(value, exact).alias("_total"),
        F.count(value).alias("_n"),
    )

    def metric(name, number) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.struct(name.alias("metrica"), number.cast("double").alias("valor"))

    per_label = metric(
        F.concat(F.lit("ciudades_"), metric_key(F.col("instrumento_recomendado"))), F.col("_rows")
    )
    folded = lines.groupBy(*by).agg(
        F.collect_list(per_label).alias("_labels"),
        F.sum("_rows").alias("_rows"),
        F.sum("_high").alias("_high"),
        mean_of(F.sum("_total"), F.sum("_n"), 2, exact).alias("_mean"),
    )
    overall = F.array(
        metric("total_ciudades_analizadas", F.coalesce("_rows", F.lit(0))),
        metric("ciudades_prioridad_alta", F.coalesce("_high", F.lit(0))),
        metric("promedio_informalidad_miles", F.col("_mean")),
        metric("cobertura_poblacion_pct", F.lit(COVERAGE_PCT)),
    )
    return folded.select(*by, F.inline(F.concat("_labels", overall)))


def log_params(store: TableStore, run_id: str, params: dict[str, object]) -> None:
    """Record parameters as text, with the time of the run."""
    rows = local_rows(store.spark, ("clave", "valor"), [(k, str(v)) for k, v in params.items()])
    stamped = rows.unionByName(
        store.spark.range(1).select(
            F.lit("fecha_ejecucion").alias("clave"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("valor"),
        )
    )
    _keep(store, _record(stamped, run_id), "run_params")


def log_metrics(store: TableStore, run_id: str, metrics: DataFrame) -> None:
    rows = metrics.select(F.col("metrica").alias("clave"), "valor")
    _keep(store, _record(rows, run_id), "run_metrics")


def _keep(store: TableStore, record: DataFrame, name: str) -> None:
    store.write(record, name, partition_by=("run_id",), mode="partitions")


def _record(rows: DataFrame, run_id: str) -> DataFrame:
    return rows.select(F.lit(run_id).alias("run_id"), "clave", "valor", F.current_timestamp().alias("ts"))


def compare_runs(records: DataFrame, keys: Sequence[str], run: str = "run_id") -> DataFrame:
    """One row per run, one column per key; the keys are given, so no pass looks for them.

    Of a key that a run recorded more than once, the newest record (``ts``) counts.
    """
    newest = F.max_by("valor", "ts") if "ts" in records.columns else F.first("valor", ignorenulls=True)
    return records.groupBy(run).pivot("clave", list(keys)).agg(newest)
