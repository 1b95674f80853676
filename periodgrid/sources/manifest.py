"""Which sheets to load, where their header is and which table they feed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import local_rows


@dataclass(frozen=True)
class SheetSpec:
    """One sheet. ``sheet`` is compared as spelled, trailing blanks included."""

    workbook: str
    sheet: str
    table: str
    concept: str
    skip_rows: int = 12


# A row below a header, with the header's labels and periods, where it came from, and what
# was wrong with it: ``error`` is set on rows that stand for something unreadable.
HEADED_COLUMNS = ("archivo", "hoja", "tabla", "etiquetas", "periodos", "orden", "celdas", "error")


@dataclass(frozen=True)
class SheetRead:
    """Rows of the sheets that were found, and the manifest lines for which none was.

    Unreadable sheets travel with the rows, so that one pass over the files yields both.
    """

    rows: DataFrame
    missing: DataFrame


def manifest_frame(spark: SparkSession, specs: Sequence[SheetSpec]) -> DataFrame:
    """The manifest as a local relation: it comes from a Python list, so it stays small."""
    rows = [(s.workbook, s.sheet, s.table, s.concept, s.skip_rows) for s in specs]
    return local_rows(spark, ("archivo", "hoja", "tabla", "columna_concepto", "saltar"), rows)


def decoded_path(path: Column) -> Column:
    """The file path as spelled on disk; Spark reports it percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def workbook_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def sheet_of(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.csv$", "")


def row_order(block: Column, line: Column) -> Column:
    """Where a row stands in its sheet: compares like its position in the file."""
    return F.struct(
        block.cast("bigint").alias("bloque"), line.cast("bigint").alias("linea")
    ).alias("orden")


def missing_sheets(manifest: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """``tabla, archivo, hoja, error`` of manifest lines that nothing in ``seen`` matches."""
    # Only what the manifest names is kept of all that was seen, so neither side grows.
    found = seen.select(*on).join(F.broadcast(manifest), list(on), "left_semi").distinct()
    return manifest.join(found, list(on), "left_anti").select(
        "tabla", "archivo", "hoja", F.lit("sheet not found").alias("error")
    )


def no_sheets(spark: SparkSession) -> DataFrame:
    """``tabla, archivo, hoja, error`` of nothing: a load of some sheets misses none of the others."""
    return spark.range(0).selectExpr(*[
        f"CAST(NULL AS STRING) AS {name}" for name in ("tabla", "archivo", "hoja", "error")
    ])
