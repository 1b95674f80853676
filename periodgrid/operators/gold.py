"""Yearly metrics, top-k evolution, multi-dimension averages, entity features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import (
    mean_of,
    partial_sum,
    round_result,
    rounded_mean,
    rounded_std,
)
from .joins import cross_one_row
from .ranking import top_k


def annual_metrics(
    silver: DataFrame, concept: str = "indicador", value: str = "valor", exact: int | None = None
) -> DataFrame:
    """Mean, minimum, maximum, sample deviation and count per (year, concept)."""
    v = F.col(value)
    return (
        silver.where(F.col("fecha").isNotNull())
        .groupBy("anio", concept)
        .agg(
            rounded_mean(v, 2, exact).alias("promedio_anual"),
            round_result(F.min(v), 2, exact).alias("valor_minimo"),
            round_result(F.max(v), 2, exact).alias("valor_maximo"),
            rounded_std(v, 2, exact).alias("desviacion_estandar"),
            F.count(F.lit(1)).alias("num_observaciones"),
        )
    )


def yearly_totals(
    silver: DataFrame, group: str, value: str, exact: int | None = None
) -> DataFrame:
    """Sum, non-null count and row count per (year, group): all a top-k evolution needs."""
    return silver.groupBy("anio", group).agg(
        partial_sum(F.col(value), exact).alias("_total"),
        F.count(value).alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
    )


def leading_groups(totals: DataFrame, group: str, k: int = 10) -> DataFrame:
    """The k groups with the largest sum over all years, ties by name."""
    # The counts are carried so that this branch and the evolution read one and the same
    # pre-aggregation, whose shuffle Spark then does once.
    overall = totals.groupBy(group).agg(
        F.sum("_total").alias("total"), F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows")
    )
    return top_k(overall.where((F.col("_rows") > 0) & (F.col("_n") >= 0)), "total", group, k)


def top_k_evolution(
    totals: DataFrame,
    group: str,
    k: int = 10,
    mean_name: str = "promedio_ocupados_miles",
    sum_name: str = "total_ocupados_miles",
    exact: int | None = None,
) -> DataFrame:
    """Yearly mean, sum and count of the k leading groups, from ``yearly_totals``.

    The facts are aggregated once; ranking and semi-join work on the yearly rows. A group that
    is NULL can lead but never joins.
    """
    leaders = leading_groups(totals, group, k).select(group)
    total = F.col("_total")
    return totals.join(F.broadcast(leaders), group, "left_semi").select(
        "anio",
        group,
        mean_of(total, F.col("_n"), 2, exact).alias(mean_name),
        (F.round(total, 2).cast("double")).alias(sum_name),
        F.col("_rows").alias("num_observaciones"),
    )


@dataclass(frozen=True)
class Dimension:
    """One part of a dashboard: rows, the label of the dimension and its category column."""

    rows: DataFrame
    label: str
    category: str | None = None
    total_label: str = "General"


def dimension_dashboard(
    parts: Sequence[Dimension],
    value: str = "valor",
    name: str = "tasa_informalidad_promedio",
    exact: int | None = None,
) -> DataFrame:
    """``anio, dimension, categoria`` and the mean, over dimensions kept in separate tables."""

    def one(part: Dimension) -> DataFrame:
        rows = part.rows.where(F.col(value).isNotNull())
        if part.category is None:
            rows, category = rows.withColumn("_cat", F.lit(part.total_label)), "_cat"
        else:
            rows, category = rows.where(F.col(part.category).isNotNull()), part.category
        return rows.groupBy("anio", category).agg(
            rounded_mean(F.col(value), 2, exact).alias(name)
        ).select("anio", F.lit(part.label).alias("dimension"), F.col(category).alias("categoria"), name)

    frames = [one(part) for part in parts]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def shared_dashboard(
    rows: DataFrame,
    dimensions: dict[str, str],
    value: str,
    total: tuple[str, str] = ("Total Nacional", "General"),
    name: str = "tasa_informalidad_promedio",
    exact: int | None = None,
) -> DataFrame:
    """The same dashboard when all dimensions are columns of one table: one scan.

    The facts are aggregated once at the finest grain; each dimension then rolls up those few
    rows, because a mean is a sum and a count.
    """
    columns = list(dimensions.values())
    fine = rows.where(F.col(value).isNotNull()).groupBy("anio", *columns).agg(
        partial_sum(F.col(value), exact).alias("_total"), F.count(value).alias("_n")
    )
    labelled = [F.struct(F.lit(total[0]).alias("dimension"), F.lit(total[1]).alias("categoria"))]
    for label, column in dimensions.items():
        labelled.append(
            F.struct(F.lit(label).alias("dimension"), F.col(column).alias("categoria"))
        )
    return (
        fine.select("anio", "_total", "_n", F.inline(F.array(*labelled)))
        .where(F.col("categoria").isNotNull())
        .groupBy("anio", "dimension", "categoria")
        .agg(mean_of(F.sum("_total"), F.sum("_n"), 2, exact).alias(name))
    )


def entity_profile(
    rows: DataFrame,
    entity: str = "ciudad",
    value: str = "valor",
    exclude_like: Sequence[str] = (),
    exclude_values: Sequence[str] = (),
    exact: int | None = None,
) -> DataFrame:
    """Mean, minimum, maximum and count per entity, placeholder and aggregate rows left out."""
    e, v = F.col(entity), F.col(value)
    kept = rows.where(e.isNotNull() & v.isNotNull())
    for pattern in exclude_like:
        kept = kept.where(~e.like(pattern))
    for literal in exclude_values:
        kept = kept.where(e != literal)
    return kept.groupBy(entity).agg(
        rounded_mean(v, 2, exact).alias("tasa_informalidad_promedio_miles"),
        round_result(F.min(v), 2, exact).alias("tasa_informalidad_min"),
        round_result(F.max(v), 2, exact).alias("tasa_informalidad_max"),
        F.count(F.lit(1)).alias("num_observaciones"),
    )


@dataclass(frozen=True)
class EducationLevels:
    """The three levels the vulnerability index compares."""

    primary: str
    secondary: str
    high: str


def vulnerability_index(
    rows: DataFrame,
    levels: EducationLevels,
    level: str = "nivel_educativo",
    value: str = "tasa_informalidad",
    exact: int | None = None,
) -> DataFrame:
    """One row: low rate, high rate and their ratio, in one scan.

    The low rate is the sum of two rounded means, rounded to a whole number and only then
    halved, so it is a multiple of one half.
    """
    wanted = (levels.primary, levels.secondary, levels.high)
    rates = (
        rows.where(F.col(level).isin(*wanted))
        .groupBy(level)
        .agg(rounded_mean(F.col(value), 2, exact).alias("_rate"))
    )

    def rate(name: str) -> Column:
        return F.max(F.when(F.col(level) == name, F.col("_rate")))

    both = rates.agg(
        (round_result(rate(levels.primary) + rate(levels.secondary), 0, exact) / 2).alias("low"),
        rate(levels.high).alias("high"),
    )
    ratio = F.try_divide(F.col("low"), F.nullif(F.col("high"), F.lit(0.0)))
    return both.select(
        round_result(ratio, 2, exact).alias("indice_vulnerabilidad_educativa"),
        F.col("low").alias("tasa_informalidad_baja_educacion"),
        F.col("high").alias("tasa_informalidad_alta_educacion"),
    )


def entity_features(profile: DataFrame, index: DataFrame, severity: Column) -> DataFrame:
    """Profile, index and severity class per entity."""
    return cross_one_row(profile, index).withColumn("severidad_informalidad", severity)
