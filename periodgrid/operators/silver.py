"""Cleaning: one builder, driven by a declarative spec per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_value
from ..functions.periods import first_of_month


@dataclass(frozen=True)
class SilverSpec:
    """How one Bronze table is cleaned.

    ``drop_values`` compares the concept as it stands, before trimming. ``dated`` rebuilds
    ``fecha`` (NULL when the month is not 1-12); ``named_months`` keeps only rows whose month
    is known and carries neither a star nor a placeholder name.
    """

    concept: str
    value: str = "valor"
    columns: tuple[str, ...] = ("anio", "mes", "mes_num", "fecha")
    lineage: tuple[str, ...] = ("_archivo_origen", "_fecha_carga")
    drop_values: tuple[str, ...] = field(default=())
    named_months: bool = False
    exact: int | None = None


def clean(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Silver rows: concept trimmed, value rounded to 2 decimals, unusable rows dropped.

    Narrow from scan to sink; the null and value filters reach the scan.
    """
    concept = F.col(spec.concept)
    rows = bronze.where(F.col("valor").isNotNull() & concept.isNotNull())
    for value in spec.drop_values:
        rows = rows.where(concept != value)
    if spec.named_months:
        month = F.col("mes")
        rows = rows.where(~(month.like("%*%") | month.like("Unnamed%")))
        rows = rows.where(F.col("mes_num").isNotNull())

    date = first_of_month(F.col("anio").cast("int"), F.col("mes_num").cast("int"))
    picked = [date.alias("fecha") if name == "fecha" else F.col(name) for name in spec.columns]
    return rows.select(
        F.trim(concept).alias(spec.concept),
        *picked,
        round_value(F.col("valor"), 2, spec.exact).alias(spec.value),
        *spec.lineage,
    )
