"""Which tables exist, what feeds them and how each is built."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.periods import DEFAULT_GRAMMAR, PeriodGrammar
from ..operators.gold import EducationLevels
from ..operators.rules import Thresholds
from ..operators.silver import SilverSpec
from ..sources.manifest import SheetSpec

# Sheet names as the workbooks spell them (the last one ends in a blank).
SHEET_NATIONAL = "Total nacional"
SHEET_SECTOR = "Ocupados TN_T13_rama"
SHEET_CITY = "Ciudades"
SHEET_SEX = "Sexo"
SHEET_EDUCATION = "Educación "

# Rows and labels that stand for something else than one more category.
SECTOR_UNKNOWN = "No informa"
HEADER_WORD = "Concepto"
CITY_PLACEHOLDERS = ("%Concepto%", "%Unnamed%")
CITY_AGGREGATE = "23 ciudades y A.M."
LEVELS = EducationLevels("Básica primaria", "Básica secundaria^", "Universitaria")

# Layer names of the inventory, in processing order.
LAYERS = ("🥉 BRONZE", "🥈 SILVER", "🥇 GOLD", "🥇 GOLD ML")


@dataclass(frozen=True)
class Survey:
    """Names and parameters of one survey.

    ``code`` is the part of the employment table names that identifies the survey;
    ``source`` is recorded with each run. ``exact`` is the number of decimals of the values, if
    they have a fixed one: sums are then exact instead of depending on the order of addition.
    """

    code: str
    employment_book: str
    informality_book: str
    source: str = ""
    grammar: PeriodGrammar = DEFAULT_GRAMMAR
    thresholds: Thresholds = field(default_factory=Thresholds)
    top_sectors: int = 10
    exact: int | None = None

    def sheets(self) -> tuple[SheetSpec, ...]:
        first, second = self.employment_book, self.informality_book
        return (
            SheetSpec(first, SHEET_NATIONAL, f"{self.code}_total_nacional", "indicador"),
            SheetSpec(
                first, SHEET_SECTOR, f"{self.code}_ocupados_rama_actividad", "rama_actividad", 13
            ),
            SheetSpec(second, SHEET_NATIONAL, "informalidad_total_nacional", "indicador"),
            SheetSpec(second, SHEET_CITY, "informalidad_ciudades", "ciudad"),
            SheetSpec(second, SHEET_SEX, "informalidad_sexo", "sexo"),
            SheetSpec(second, SHEET_EDUCATION, "informalidad_educacion", "nivel_educativo"),
        )

    def silver(self) -> dict[str, tuple[str, SilverSpec]]:
        """Silver table -> (Bronze table, cleaning)."""
        exact = self.exact
        lineage = ("_archivo_origen", "_fecha_carga")
        rate = "tasa_informalidad"
        return {
            f"silver_{self.code}_total_nacional": (
                f"bronze_{self.code}_total_nacional",
                SilverSpec(
                    "indicador",
                    columns=("anio", "mes", "mes_num", "fecha", "periodo"),
                    lineage=("_archivo_origen", "_hoja_origen", "_fecha_carga"),
                    named_months=True,
                    exact=exact,
                ),
            ),
            f"silver_{self.code}_ocupados_rama": (
                f"bronze_{self.code}_ocupados_rama_actividad",
                SilverSpec(
                    "rama_actividad",
                    value="ocupados_miles",
                    columns=("anio", "periodo"),
                    lineage=lineage,
                    drop_values=(SECTOR_UNKNOWN,),
                    exact=exact,
                ),
            ),
            "silver_informalidad_total_nacional": (
                "bronze_informalidad_total_nacional",
                SilverSpec("indicador", lineage=lineage, exact=exact),
            ),
            "silver_informalidad_ciudades": (
                "bronze_informalidad_ciudades",
                SilverSpec("ciudad", rate, lineage=lineage, exact=exact),
            ),
            "silver_informalidad_sexo": (
                "bronze_informalidad_sexo",
                SilverSpec("sexo", rate, lineage=lineage, exact=exact),
            ),
            "silver_informalidad_educacion": (
                "bronze_informalidad_educacion",
                SilverSpec("nivel_educativo", rate, lineage=lineage, exact=exact),
            ),
        }
