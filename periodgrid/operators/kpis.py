"""Dashboard measures and result summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_result, rounded_mean, rounded_sum


def rate_by_year(rows: DataFrame, value: str, name: str = "tasa", exact: int | None = None) -> DataFrame:
    return rows.groupBy("anio").agg(rounded_mean(F.col(value), 2, exact).alias(name))


def volume_by_group(
    rows: DataFrame, by: Sequence[str], value: str, name: str = "volumen", exact: int | None = None
) -> DataFrame:
    return rows.groupBy(*by).agg(rounded_sum(F.col(value), 2, exact).alias(name))


def group_gap(
    rows: DataFrame, group: str, first: str, second: str, value: str, by: Sequence[str] = (),
    name: str = "brecha_pp", exact: int | None = None,
) -> DataFrame:
    """Mean of one group minus mean of another, both from one pass."""
    g, v = F.col(group), F.col(value)
    wanted = rows.where(g.isin(first, second))
    means = wanted.groupBy(*by).agg(
        rounded_mean(F.when(g == first, v), 2, exact).alias("_a"),
        rounded_mean(F.when(g == second, v), 2, exact).alias("_b"),
    )
    return means.select(*by, round_result(F.col("_a") - F.col("_b"), 2, exact).alias(name))


def most_frequent(rows: DataFrame, label: str, name: str = "veces") -> DataFrame:
    """The most frequent label (one row), ties by label."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), F.col(label).asc()).limit(1)


def distribution(
    recommendations: DataFrame, by: Sequence[str], with_mean: bool = False, exact: int | None = None
) -> DataFrame:
    """Entities, their total and (on request) their mean per label, rounded to whole numbers."""
    value = F.col("tasa_informalidad_promedio_miles")
    measures = [
        F.count(F.lit(1)).alias("num_ciudades"),
        rounded_sum(value, 0, exact).alias("total_informales_miles"),
    ]
    if with_mean:
        measures.append(rounded_mean(value, 0, exact).alias("promedio_informales_miles"))
    return recommendations.groupBy(*by).agg(*measures)


def executive_top(recommendations: DataFrame, entity: str = "ciudad", k: int = 10) -> DataFrame:
    """The k entities with the largest value, with their recommendation."""
    value = "tasa_informalidad_promedio_miles"
    columns = (entity, value, "instrumento_recomendado", "prioridad")
    return recommendations.select(*columns).orderBy(F.col(value).desc(), F.col(entity).asc()).limit(k)
