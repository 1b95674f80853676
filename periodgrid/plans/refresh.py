"""The whole refresh: sheets -> Bronze -> Silver -> Gold -> recommendations, in data order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import gold, quality
from ..operators.rules import default_rules, recommend, severity_band
from ..operators.silver import clean
from ..sources.manifest import SheetRead
from ..sources.tables import TableStore, ingest, load_report, table_rows
from .layers import (
    CITY_AGGREGATE,
    CITY_PLACEHOLDERS,
    HEADER_WORD,
    LAYERS,
    LEVELS,
    Survey,
)
from .runs import log_metrics, log_params, recommendation_metrics

#: What Gold tables are read by: their files are ranges of it.
GOLD_ORDER = {
    "gold_metricas_empleo_anual": ("anio", "indicador"),
    "gold_empleo_top_ramas": ("anio", "rama_actividad"),
    "gold_dashboard_informalidad": ("anio", "dimension", "categoria"),
    "gold_perfil_ciudades_ml": ("ciudad",),
}
INFORMALITY = ("informalidad_total_nacional", "informalidad_sexo", "informalidad_educacion")


def load_bronze(store: TableStore, read: SheetRead, survey: Survey) -> DataFrame:
    """All sheets in one pass, then one table per manifest line. Returns the load report.

    A table keeps its last good state if one of its sheets is missing or cannot be read. Only a
    table that was never loaded is made from what there is, so that later layers find it.
    """
    specs = survey.sheets()
    done = ingest(read, store=True, specs=specs)
    # At most one row per manifest line.
    failed = {row.tabla for row in done.quarantine.select("tabla").distinct().collect()}
    fresh = [spec for spec in specs if spec.table not in failed or not store.exists(f"bronze_{spec.table}")]
    store.write_all({f"bronze_{spec.table}": table_rows(done.bronze, spec) for spec in fresh})
    return load_report(done, specs)


def build_silver(store: TableStore, survey: Survey) -> None:
    store.write_all({
        name: clean(store.read(source), spec) for name, (source, spec) in survey.silver().items()
    })


def gold_tables(store: TableStore, survey: Survey) -> dict[str, DataFrame]:
    """The descriptive Gold tables. Row order is left to the reader; it is no table property."""
    sectors, exact = store.read(f"silver_{survey.code}_ocupados_rama"), survey.exact
    totals = gold.yearly_totals(sectors, "rama_actividad", "ocupados_miles", exact)
    national, by_sex, by_level = (store.read(f"bronze_{name}") for name in INFORMALITY)
    return {
        "gold_metricas_empleo_anual": gold.annual_metrics(
            store.read(f"silver_{survey.code}_total_nacional"), exact=exact
        ),
        "gold_empleo_top_ramas": gold.top_k_evolution(
            totals, "rama_actividad", survey.top_sectors, exact=exact
        ),
        "gold_dashboard_informalidad": gold.dimension_dashboard([
            gold.Dimension(national.where(F.col("indicador") != HEADER_WORD), "Total Nacional"),
            gold.Dimension(by_sex, "Sexo", "sexo"),
            gold.Dimension(by_level, "Nivel Educativo", "nivel_educativo"),
        ], exact=exact),
    }


def city_features(store: TableStore, survey: Survey) -> DataFrame:
    profile = gold.entity_profile(
        store.read("bronze_informalidad_ciudades"),
        exclude_like=CITY_PLACEHOLDERS,
        exclude_values=(CITY_AGGREGATE,),
        exact=survey.exact,
    )
    index = gold.vulnerability_index(
        store.read("silver_informalidad_educacion"), LEVELS, exact=survey.exact
    )
    severity: Column = severity_band(
        F.col("tasa_informalidad_promedio_miles"), survey.thresholds
    )
    return gold.entity_features(profile, index, severity)


def inventory(store: TableStore, survey: Survey) -> DataFrame:
    """``capa, tabla, num_filas`` of all tables of the refresh."""
    bronze = [f"bronze_{spec.table}" for spec in survey.sheets()]
    layered = [
        (LAYERS[0], bronze),
        (LAYERS[1], list(survey.silver())),
        (LAYERS[2], [
            "gold_metricas_empleo_anual", "gold_empleo_top_ramas", "gold_dashboard_informalidad",
        ]),
        (LAYERS[3], ["gold_perfil_ciudades_ml", "gold_recomendaciones_focalizacion"]),
    ]
    return quality.inventory(
        [(layer, name, store.read(name), store.rows_written(name)) for layer, names in layered for name in names]
    )


def ordered_inventory(rows: DataFrame) -> DataFrame:
    return rows.orderBy(quality.layer_order(F.col("capa"), LAYERS), "tabla")


def refresh(store: TableStore, read: SheetRead, survey: Survey, run_id: str) -> DataFrame:
    """Rebuild every table and record the run. Returns the load report."""
    report = load_bronze(store, read, survey)
    build_silver(store, survey)
    features = {"gold_perfil_ciudades_ml": city_features(store, survey)}
    store.write_all({**gold_tables(store, survey), **features}, order_by=GOLD_ORDER)

    output = "gold_recomendaciones_focalizacion"
    rules = default_rules(survey.thresholds)
    store.write(recommend(store.read("gold_perfil_ciudades_ml"), rules), output, order_by=("ciudad",))

    log_params(store, run_id, {
        "umbral_alta_severidad_miles": survey.thresholds.high,
        "umbral_media_severidad_miles": survey.thresholds.medium,
        "umbral_vulnerabilidad_educativa": survey.thresholds.index,
        "fuente_datos": survey.source,
        "tabla_output": store.full_name(output),
    })
    log_metrics(store, run_id, recommendation_metrics(store.read(output), exact=survey.exact))
    return report
