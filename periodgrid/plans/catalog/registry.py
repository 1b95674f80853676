"""Registration of queries, the tables they read and shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ...functions.periods import MONTHS_ES, PeriodGrammar

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The test orders span these years; the first one is written without a suffix.
FIRST_YEAR, LAST_YEAR = 1995, 2001
GRAMMAR = PeriodGrammar(base_year=FIRST_YEAR, max_suffix=LAST_YEAR - FIRST_YEAR)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function name, with the SQL for the same rows."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_of(date: str) -> Column:
    return F.year(date).cast("int")


def month_name(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), number)


# -- SQL fragments ------------------------------------------------------------------------

def month_sql(number: str) -> str:
    lines = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS_ES, 1))
    return f"CASE {number} {lines} END"


def year_sql(date: str) -> str:
    return f"CAST(year({date}) AS INTEGER)"


def money_sql(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def round_sql(value: str, places: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def mean_sql(value: str, places: int = 2) -> str:
    return round_sql(f"CAST(sum({money_sql(value)}) AS DOUBLE) / count({value})", places)


def sum_sql(value: str, places: int = 2) -> str:
    return f"CAST(round(sum({money_sql(value)}), {places}) AS DOUBLE)"
