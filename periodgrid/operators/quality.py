"""Inventories and checks, each one aggregate over the data it looks at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import local_rows
from .joins import join_hot_keys


def inventory(tables: Sequence[tuple]) -> DataFrame:
    """``capa, tabla, num_filas`` per table: ``(layer, name, rows)``, or with a count that is known
    already ``(layer, name, rows, count)``. Other counts read footers only."""
    known = [(t[0], t[1], t[3]) for t in tables if len(t) > 3 and t[3] is not None]
    frames = [
        df.agg(F.count(F.lit(1)).alias("num_filas")).select(
            F.lit(layer).alias("capa"), F.lit(name).alias("tabla"), "num_filas"
        )
        for layer, name, df, *count in tables if not count or count[0] is None
    ]
    if known:
        told = local_rows(tables[0][2].sparkSession, ("capa", "tabla", "num_filas"), known)
        frames.append(told.withColumn("num_filas", F.col("num_filas").cast("bigint")))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def layer_order(layer: Column, layers: Sequence[str]) -> Column:
    """Position of a layer in processing order, unknown layers last."""
    names = F.array(*[F.lit(name) for name in layers])
    position = F.array_position(names, layer)
    return F.when(position > 0, position).otherwise(len(layers) + 1).cast("int")


def retention(before: DataFrame, after: DataFrame, key: str = "tabla", count: str = "num_filas") -> DataFrame:
    """Rows before and after, rows lost, share kept, per inventory line."""
    b = before.select(key, F.col(count).alias("filas_antes"))
    a = after.select(F.col(key).alias("_key"), F.col(count).alias("filas_despues"))
    joined = b.join(a, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
        "filas_despues", F.coalesce("filas_despues", F.lit(0))
    )
    kept = F.try_divide(F.col("filas_despues").cast("double") * 100, F.col("filas_antes"))
    return joined.select(
        key,
        "filas_antes",
        "filas_despues",
        (F.col("filas_antes") - F.col("filas_despues")).alias("filas_perdidas"),
        F.round(kept.cast("decimal(38,6)"), 2).cast("double").alias("retencion_pct"),
    )


def counts_by_condition(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``metrica, cantidad``: rows that meet each condition, all from one pass."""
    names = list(conditions)
    slots = [f"_m{i}" for i in range(len(names))]
    one = rows.agg(*[F.count_if(conditions[n]).alias(s) for n, s in zip(names, slots)])
    pairs = [F.struct(F.lit(n).alias("metrica"), F.col(s).alias("cantidad")) for n, s in zip(names, slots)]
    return one.select(F.inline(F.array(*pairs)))


def non_empty(counts: DataFrame, count: str = "num_filas") -> DataFrame:
    return counts.withColumn("no_vacia", F.col(count) > 0)


def range_check(rows: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """``columna, fuera_de_rango``: values outside their limits, for all columns in one pass."""
    outside = counts_by_condition(rows, {n: ~F.col(n).between(*lim) for n, lim in limits.items()})
    return outside.select(
        F.col("metrica").alias("columna"), F.col("cantidad").alias("fuera_de_rango")
    )


def outliers(rows: DataFrame, by: Sequence[str], value: str, limit: float = 3.0) -> DataFrame:
    """Rows further than ``limit`` sample deviations from the mean of their group, with ``z``.

    Group statistics are aggregated (map side first) and joined back; a group of any size is
    spread over many tasks (see ``join_hot_keys``).
    """
    stats = rows.groupBy(*by).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")
    )
    joined = join_hot_keys(rows, stats, by)
    z = F.try_divide(F.col(value) - F.col("_mean"), F.nullif(F.col("_std"), F.lit(0.0)))
    return joined.withColumn("z", z).where(F.abs("z") > limit).drop("_mean", "_std")


def missing_months(rows: DataFrame, by: Sequence[str], date: str = "fecha") -> DataFrame:
    """Months between the first and the last of a series that have no row: one scan.

    After the distinct months are known, a gap is visible between neighbours.
    """
    month = F.trunc(F.col(date).cast("date"), "month")
    months = rows.where(F.col(date).isNotNull()).select(*by, month.alias("_month")).distinct()
    series = Window.partitionBy(*by).orderBy("_month")
    gaps = months.withColumn("_next", F.lead("_month").over(series))
    one = F.make_ym_interval(F.lit(0), F.lit(1))
    first = F.add_months("_month", 1)
    last = F.add_months("_next", -1)
    return gaps.where(first <= last).select(
        *by, F.explode(F.sequence(first, last, one)).alias("mes_faltante")
    )


def repeated_keys(rows: DataFrame, keys: Sequence[str], name: str = "veces") -> DataFrame:
    """Keys that occur more than once."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.where(F.col(name) > 1)
