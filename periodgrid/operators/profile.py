"""Profiling: shapes, types, nulls, distinct values, ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def shape(rows: DataFrame, table: str) -> DataFrame:
    """``tabla, filas, columnas``."""
    return rows.agg(F.count(F.lit(1)).alias("filas")).select(
        F.lit(table).alias("tabla"), "filas", F.lit(len(rows.columns)).alias("columnas")
    )


def first_columns(rows: DataFrame, n: int = 20) -> list[str]:
    return rows.columns[:n]


def type_histogram(rows: DataFrame) -> DataFrame:
    """``tipo, columnas, celdas``: columns of each type and how many non-null cells they hold."""
    by_type: dict[str, list[str]] = {}
    for name, kind in rows.dtypes:
        by_type.setdefault(kind, []).append(name)
    kinds = list(by_type)
    cells = []
    for i, kind in enumerate(kinds):
        counted = F.lit(0).cast("bigint")
        for name in by_type[kind]:
            counted = counted + F.count(F.col(f"`{name}`"))
        cells.append(counted.alias(f"_t{i}"))
    lines = [
        F.struct(
            F.lit(kind).alias("tipo"),
            F.lit(len(by_type[kind])).alias("columnas"),
            F.col(f"_t{i}").alias("celdas"),
        )
        for i, kind in enumerate(kinds)
    ]
    return rows.agg(*cells).select(F.inline(F.array(*lines)))


def null_counts(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``columna, nulos`` for the given columns, by default all, in one pass."""
    return _per_column(rows, columns or rows.columns, "nulos", lambda c: F.count_if(c.isNull()))


def distinct_counts(
    rows: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """``columna, distintos`` without NULL. The approximate form keeps fixed-size sketches."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _per_column(rows, columns, "distintos", count)


def _per_column(rows: DataFrame, columns: Sequence[str], name: str, measure) -> DataFrame:
    slots = [f"_p{i}" for i in range(len(columns))]
    one = rows.agg(*[measure(F.col(f"`{c}`")).alias(s) for c, s in zip(columns, slots)])
    lines = [F.struct(F.lit(c).alias("columna"), F.col(s).alias(name)) for c, s in zip(columns, slots)]
    return one.select(F.inline(F.array(*lines)))


def value_range(
    frame: DataFrame, column: str, low: str = "minimo", high: str = "maximo", rows: str | None = None
) -> DataFrame:
    """Least and largest value, and with ``rows`` the number of rows under that name, in one pass."""
    counted = [F.count(F.lit(1)).alias(rows)] if rows else []
    return frame.agg(F.min(column).alias(low), F.max(column).alias(high), *counted)


def first_values(rows: DataFrame, column: str, position: Sequence[str], n: int = 10) -> DataFrame:
    """The first n distinct values (NULL included) in order of appearance."""
    where = F.struct(*position) if len(position) > 1 else F.col(position[0])
    return (
        rows.groupBy(column)
        .agg(F.min(where).alias("primera"))
        .orderBy("primera")
        .limit(n)
    )
