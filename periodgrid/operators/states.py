"""Aggregates as states that merge: count, sum, least, greatest and squared deviations.

The state of a group over some rows can be stored and merged with the states of other rows, in
any order, to what one pass over all rows would give. Squared deviations are merged by the rule of
pairwise moments: deviations within the parts plus those of the parts' means from the common mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import mean_of, partial_sum, round_result

STATE_COLUMNS = ("_filas", "_n", "_suma", "_minimo", "_maximo", "_media", "_m2")


def partial_states(rows: DataFrame, by: Sequence[str], value: str = "valor", exact: int | None = None) -> DataFrame:
    """``by`` and the state of ``value`` per group. NULL values count as rows only."""
    v = F.col(value)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_filas"),
        F.count(v).alias("_n"),
        partial_sum(v, exact).alias("_suma"),
        F.min(v).alias("_minimo"),
        F.max(v).alias("_maximo"),
        F.avg(v).alias("_media"),
        (F.var_pop(v) * F.count(v)).alias("_m2"),
    )


def merge_states(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of the groups ``by`` from those of finer groups or of several parts.

    The common mean is needed beside each state, so a group's states meet in one window: there is
    one per part, as many as the group has slices.
    """
    group = Window.partitionBy(*by)
    weighted = F.sum(F.col("_media") * F.col("_n")).over(group)
    mean = F.try_divide(weighted, F.sum("_n").over(group))
    beside = states.withColumn("_centro", mean)
    apart = F.col("_n") * F.pow(F.col("_media") - F.col("_centro"), F.lit(2.0))
    return beside.groupBy(*by).agg(
        F.sum("_filas").alias("_filas"),
        F.sum("_n").alias("_n"),
        F.sum("_suma").alias("_suma"),
        F.min("_minimo").alias("_minimo"),
        F.max("_maximo").alias("_maximo"),
        F.max("_centro").alias("_media"),
        F.sum(F.col("_m2") + apart).alias("_m2"),
    )


def annual_from_states(states: DataFrame, by: Sequence[str], exact: int | None = None) -> DataFrame:
    """Mean, minimum, maximum, sample deviation and count, rounded, of merged states."""
    deviation = F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
    return states.select(
        *by,
        mean_of(F.col("_suma"), F.col("_n"), 2, exact).alias("promedio_anual"),
        round_result(F.col("_minimo"), 2, exact).alias("valor_minimo"),
        round_result(F.col("_maximo"), 2, exact).alias("valor_maximo"),
        round_result(deviation, 2, exact).alias("desviacion_estandar"),
        F.col("_filas").alias("num_observaciones"),
    )


def mean_from_states(states: DataFrame, by: Sequence[str], name: str, exact: int | None = None) -> DataFrame:
    """The rounded mean per group, from states that are finer or of several parts."""
    return states.groupBy(*by).agg(F.sum("_suma").alias("_suma"), F.sum("_n").alias("_n")).where("_n > 0").select(
        *by, mean_of(F.col("_suma"), F.col("_n"), 2, exact).alias(name))
