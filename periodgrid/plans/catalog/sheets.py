"""Sheets derived from the tables, written as text, read back through the manifest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ...functions.numeric import fixed_sum
from ...functions.periods import MONTHS_ES
from ...operators.reshape import column_accounting, explode_cells
from ...operators.rules import Thresholds
from ...session import delete_path, fresh_path
from ...sources.csv_sheets import (
    headed_from_text, read_csv_sheets, sheet_catalog as list_sheets, split_fields, split_records,
)
from ...sources.manifest import SheetRead, SheetSpec, manifest_frame, no_sheets
from ...sources.slices import SliceStore
from ...sources.snapshots import load_changes
from ...sources.tables import TableStore, ingest, load_report
from ...sources.xlsx_sheets import read_xlsx_sheets, sheet_catalog as list_workbook_sheets
from ...sources.xlsx_write import write_workbooks
from ...streaming.incremental import ingest_new_sheets, stored_bronze
from ..incremental_gold import GoldStates
from ..layers import (
    CITY_AGGREGATE,
    LAYERS,
    LEVELS,
    SECTOR_UNKNOWN,
    SHEET_CITY,
    SHEET_EDUCATION,
    SHEET_NATIONAL,
    SHEET_SECTOR,
    SHEET_SEX,
    Survey,
)
from ..refresh import inventory, ordered_inventory, refresh
from .features import INDEX, REASON_SQL, VALUE, band_sql, label_sql
from .registry import (
    FIRST_YEAR,
    GRAMMAR,
    mean_sql,
    money_sql,
    month_sql,
    query,
    round_sql,
    sum_sql,
    table,
    year_sql,
)
from .series import MONTH_LABELS, QUARTER_LABELS, YEARS, monthly_cells, quarter_name

ORDERS_BOOK, LINES_BOOK = "pedidos", "envios"
ORDER_SHEETS, LINE_SHEETS = ("F", "O", "P"), ("A", "N", "R")
MANIFEST = tuple(
    [SheetSpec(ORDERS_BOOK, name, f"pedidos_{name}", "prioridad", 12) for name in ORDER_SHEETS]
    + [SheetSpec(LINES_BOOK, name, f"envios_{name}", "estado", 13) for name in LINE_SHEETS]
)
TITLE = '"Anexo, con título",\n'


def sheet_files(
    rows: DataFrame, book: str, sheet: str, concept: str, date: str, value: str, skip: int,
    quarter: bool = False, extra: tuple[str, ...] = (), title: str = TITLE, corner: str = "",
) -> DataFrame:
    """``archivo, hoja, value``: each sheet as one text with title rows and a repeated header.

    A sheet has one line per concept, and only columns with few distinct values serve as
    concepts here, so a text stays a few kilobytes at any size of the facts.
    """
    labels = QUARTER_LABELS if quarter else MONTH_LABELS
    cells = monthly_cells(
        rows.withColumn("hoja", F.col(sheet)), concept, date, value, quarter, keep=("hoja",)
    )
    wide = cells.groupBy("hoja", "concepto").pivot("etiqueta", labels).agg(
        fixed_sum(F.col("importe"), 2)
    )
    texts = [f"coalesce(CAST(`{name}` AS STRING), '')" for name in labels]
    padding = ["'9'" for _ in extra]
    line = f"concat_ws(',', {', '.join(['concepto', *texts, *padding])}) AS linea"
    lines = wide.selectExpr("hoja", "concepto", line)
    names = [quarter_name(m) for m in range(1, 13)] if quarter else list(MONTHS_ES)
    header = ",".join([corner, *(name for _ in YEARS for name in names), *extra])
    body = F.concat_ws(
        "\n",
        F.transform(
            F.array_sort(F.collect_list(F.struct("concepto", "linea"))), lambda row: row["linea"]
        ),
    )
    return lines.groupBy("hoja").agg(
        F.concat(F.lit(title * skip), F.lit(header + "\n"), body).alias("value")
    ).select(F.lit(book).alias("archivo"), F.col("hoja").cast("string").alias("hoja"), "value")


def orders_sheets(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return sheet_files(
        table(spark, sf_dir, "orders"), ORDERS_BOOK, "o_orderstatus", "o_orderpriority",
        "o_orderdate", "o_totalprice", 12, extra=extra,
    )


def derived_sheets(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    orders = orders_sheets(spark, sf_dir, extra)
    lines = sheet_files(
        table(spark, sf_dir, "lineitem"), LINES_BOOK, "l_returnflag", "l_linestatus",
        "l_shipdate", "l_extendedprice", 13, extra=extra,
    )
    return orders.unionByName(lines)


def write_sheets(sheets: DataFrame, root: str) -> None:
    """One folder per sheet, in the layout Spark itself reads back."""
    sheets.write.mode("append").partitionBy("archivo", "hoja").text(root)


def rows_from_text(spark: SparkSession, sheets: DataFrame, **options) -> DataFrame:
    return headed_from_text(sheets, manifest_frame(spark, MANIFEST), **options)


def loaded(read: SheetRead) -> DataFrame:
    return ingest(read).bronze.drop("_fecha_carga")


def cells_sql(prefix: str, sheet: str, concept: str, date: str, value: str, source: str) -> str:
    gap = f"year({date}) - {FIRST_YEAR}"
    month = month_sql(f"month({date})")
    return f"""
SELECT '{prefix}_' || {sheet} AS tabla, {concept} AS concepto, {year_sql(date)} AS anio, {month} AS mes,
       CAST(month({date}) AS INTEGER) AS mes_num, CAST(date_trunc('month', {date}) AS DATE) AS fecha,
       {month} || CASE WHEN {gap} = 0 THEN '' ELSE '.' || CAST({gap} AS VARCHAR) END AS periodo,
       CAST(sum({money_sql(value)}) AS DOUBLE) AS valor, '{prefix}' AS _archivo_origen, {sheet} AS _hoja_origen
FROM {source} GROUP BY ALL"""


ORDER_CELLS = cells_sql(
    "pedidos", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice", "orders"
)
LINE_CELLS = cells_sql(
    "envios", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice", "lineitem"
)
CELLS_SQL = f"{ORDER_CELLS} UNION ALL {LINE_CELLS}"


@query(CELLS_SQL)
def grid_skip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with 12 or 13 title rows, read without touching a file."""
    rows = rows_from_text(spark, derived_sheets(spark, sf_dir), grammar=GRAMMAR)
    return loaded(SheetRead(rows, no_sheets(spark)))


@query(CELLS_SQL)
def grid_ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six sheets of two workbooks, written to files and loaded by one job."""
    root = fresh_path(spark, "sheets")
    write_sheets(derived_sheets(spark, sf_dir), root)
    read = read_csv_sheets(spark, root, MANIFEST, GRAMMAR, partitioned=True)
    return loaded(read)


@query(CELLS_SQL)
def grid_ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through the reader for sheets too large for one record."""
    root = fresh_path(spark, "sheets")
    write_sheets(derived_sheets(spark, sf_dir), root)
    read = read_csv_sheets(spark, root, MANIFEST, GRAMMAR, whole_file_bytes=0, partitioned=True)
    return loaded(read)


def broken_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets whose titles, first header cell and concepts hold quotes, commas and line breaks."""
    concept = F.concat(F.lit('"'), F.replace("o_orderpriority", F.lit("-"), F.lit('-\n,""')), F.lit('"'))
    return sheet_files(
        table(spark, sf_dir, "orders").withColumn("_concept", concept), ORDERS_BOOK, "o_orderstatus", "_concept",
        "o_orderdate", "o_totalprice", 12, title='"Anexo,\n""con"" título\n",\n', corner='"prio\n\nridad"')


BROKEN_SQL = cells_sql(
    "pedidos", "o_orderstatus", "replace(o_orderpriority, '-', '-' || chr(10) || ',\"')", "o_orderdate", "o_totalprice", "orders")


def _ingested(spark: SparkSession, sheets: DataFrame, **options) -> DataFrame:
    root = fresh_path(spark, "sheets")
    write_sheets(sheets, root)
    return loaded(read_csv_sheets(spark, root, MANIFEST, GRAMMAR, partitioned=True, **options))


@query(BROKEN_SQL)
def grid_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks in titles, header and cells, each sheet read as one text."""
    return _ingested(spark, broken_sheets(spark, sf_dir))


@query(BROKEN_SQL)
def grid_line_breaks_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by the reader of lines, which puts the records together again."""
    return _ingested(spark, broken_sheets(spark, sf_dir), whole_file_bytes=0)


@query(CELLS_SQL)
def incremental_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets that arrive in two waves, loaded by two runs of one stream."""
    root, target, state = (fresh_path(spark, name) for name in ("inbox", "bronze", "state"))
    sheets = derived_sheets(spark, sf_dir)
    for book in (ORDERS_BOOK, LINES_BOOK):
        write_sheets(sheets.where(F.col("archivo") == book), root)
        ingest_new_sheets(
            spark, root, MANIFEST, target, state, GRAMMAR, partitioned=True
        ).awaitTermination()
    return stored_bronze(spark, target).drop("_fecha_carga")


def second_delivery(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Sheet F of the orders loses a concept, O keeps its header only, A of the lines is taken away."""
    sheets = derived_sheets(spark, sf_dir).where(F.col("hoja").isin("F", "O"))
    kept = F.array_join(F.filter(F.split("value", "\n"), lambda line: ~line.startswith("1-URGENT")), "\n")
    header = F.array_join(F.slice(F.split("value", "\n"), 1, 13), "\n")
    changed = sheets.withColumn("value", F.when(F.col("hoja") == "F", kept).otherwise(header))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archivo", "hoja").text(root)
    delete_path(spark, f"{root}/archivo={LINES_BOOK}/hoja=A")


def snapshot_waves(
    spark: SparkSession, sf_dir: str, after: Callable[[SliceStore], object] | None = None
) -> tuple[list[DataFrame], SliceStore]:
    """Three loads of one folder: everything, the second delivery, and the same folder once more."""
    root, target = fresh_path(spark, "inbox"), fresh_path(spark, "slices")
    write_sheets(derived_sheets(spark, sf_dir), root)
    reports = []
    for wave in range(3):
        if wave == 1:
            second_delivery(spark, sf_dir, root)
        reports.append(load_changes(spark, root, MANIFEST, target, GRAMMAR, partitioned=True))
        if after:
            after(SliceStore(spark, target))
    return reports, SliceStore(spark, target)


AFTER_SQL = f"""
SELECT * FROM ({ORDER_CELLS}) o WHERE _hoja_origen = 'P' OR (_hoja_origen = 'F' AND concepto <> '1-URGENT')
UNION ALL SELECT * FROM ({LINE_CELLS}) l WHERE _hoja_origen <> 'A'"""


@query(AFTER_SQL)
def snapshot_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a second delivery that changes, empties and takes away sheets."""
    return snapshot_waves(spark, sf_dir)[1].rows().drop("_fecha_carga")


def states_after_waves(spark: SparkSession, sf_dir: str) -> GoldStates:
    """States brought up to date after each of the three loads."""
    _, store = snapshot_waves(spark, sf_dir, lambda store: GoldStates(store, exact=2).update())
    return GoldStates(store, exact=2)


@query(f"""
SELECT tabla, anio, concepto, {mean_sql('valor')} AS promedio_anual, {round_sql('min(valor)')} AS valor_minimo,
       {round_sql('max(valor)')} AS valor_maximo, {round_sql('stddev_samp(valor)')} AS desviacion_estandar,
       count(*) AS num_observaciones FROM ({AFTER_SQL}) b GROUP BY ALL""")
def annual_metrics_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly metrics merged from states per slice, after sheets changed, emptied and went."""
    return states_after_waves(spark, sf_dir).annual_metrics()


@query(f"SELECT tabla, anio, {mean_sql('valor')} AS promedio FROM ({AFTER_SQL}) b GROUP BY ALL")
def yearly_means_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean over all concepts from the same states."""
    return states_after_waves(spark, sf_dir).yearly_means()


@query("""
SELECT CAST(1 AS INTEGER) AS carga, 'pedidos' AS archivo, o_orderstatus AS hoja, 'nueva' AS cambio FROM orders GROUP BY ALL
UNION ALL SELECT 1, 'envios', l_returnflag, 'nueva' FROM lineitem GROUP BY ALL
UNION ALL SELECT 2, 'pedidos', o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'cambiada' ELSE 'igual' END FROM orders GROUP BY ALL
UNION ALL SELECT 2, 'envios', l_returnflag, CASE WHEN l_returnflag = 'A' THEN 'retirada' ELSE 'igual' END FROM lineitem GROUP BY ALL
UNION ALL SELECT 3, 'pedidos', o_orderstatus, 'igual' FROM orders GROUP BY ALL
UNION ALL SELECT 3, 'envios', l_returnflag, 'igual' FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the three loads found."""
    reports, _ = snapshot_waves(spark, sf_dir)
    numbered = [r.where("error IS NULL").select(F.lit(k).alias("carga"), "archivo", "hoja", "cambio") for k, r in enumerate(reports, 1)]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


BOOK_MANIFEST = tuple(replace(spec, workbook=f"{spec.workbook}.xlsx") for spec in MANIFEST)


def derived_books(spark: SparkSession, sf_dir: str) -> str:
    """The derived sheets as two xlsx workbooks in the shared folder, made by the executors."""
    root = fresh_path(spark, "books")
    cells = F.transform(split_records(F.col("value")), split_fields)
    sheets = derived_sheets(spark, sf_dir).select(F.concat("archivo", F.lit(".xlsx")).alias("archivo"), "hoja", cells.alias("filas"))
    write_workbooks(sheets, root)
    return root


@query(f"SELECT * REPLACE (_archivo_origen || '.xlsx' AS _archivo_origen) FROM ({CELLS_SQL}) c")
def xlsx_ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six sheets of two workbooks, a task per sheet."""
    return loaded(read_xlsx_sheets(spark, derived_books(spark, sf_dir), BOOK_MANIFEST, GRAMMAR))


CATALOG_SQL = """
SELECT 'pedidos' AS archivo, CAST(row_number() OVER (ORDER BY o_orderstatus) AS INTEGER) AS numero,
       o_orderstatus AS hoja FROM (SELECT DISTINCT o_orderstatus FROM orders) o
UNION ALL SELECT 'envios', CAST(row_number() OVER (ORDER BY l_returnflag) AS INTEGER), l_returnflag
FROM (SELECT DISTINCT l_returnflag FROM lineitem) l"""


@query(CATALOG_SQL)
def sheet_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "sheets")
    write_sheets(derived_sheets(spark, sf_dir), root)
    return list_sheets(spark, root, partitioned=True)


QUARANTINE_SQL = """
SELECT 'pedidos' AS archivo, o_orderstatus AS hoja, 'unbalanced quotes' AS error
FROM orders WHERE o_orderstatus = 'P' GROUP BY 2
UNION ALL SELECT 'envios', l_returnflag, 'no header row below the skipped rows'
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2
UNION ALL SELECT 'pedidos', 'Z', 'sheet not found'"""


def _quarantine(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    text = F.col("value")
    spoilt = derived_sheets(spark, sf_dir).withColumn(
        "value",
        F.when(F.col("hoja") == "P", F.concat(text, F.lit('\n"x,1')))
        .when(F.col("hoja") == "R", F.lit(TITLE * 3))
        .otherwise(text),
    )
    root = fresh_path(spark, "sheets")
    write_sheets(spoilt, root)
    listed = (*MANIFEST, SheetSpec(ORDERS_BOOK, "Z", "pedidos_Z", "prioridad"))
    return ingest(read_csv_sheets(spark, root, listed, GRAMMAR, partitioned=True, **options)).quarantine.drop("tabla")


@query(f"SELECT * REPLACE (archivo || '.xlsx' AS archivo) FROM ({CATALOG_SQL}) c")
def xlsx_sheet_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_workbook_sheets(spark, derived_books(spark, sf_dir))


@query(QUARANTINE_SQL)
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A torn sheet, a sheet shorter than its title and a missing one are reported."""
    return _quarantine(spark, sf_dir)


@query(QUARANTINE_SQL)
def ingest_quarantine_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the reader of lines."""
    return _quarantine(spark, sf_dir, whole_file_bytes=0)


@query("""
SELECT 'pedidos_' || o_orderstatus AS tabla, count(*) AS filas, CAST(10 AS INTEGER) AS columnas, true AS cargada
FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, date_trunc('month', o_orderdate) FROM orders) o GROUP BY 1
UNION ALL SELECT 'envios_' || l_returnflag, count(*), 10, true
FROM (SELECT DISTINCT l_returnflag, l_linestatus, date_trunc('month', l_shipdate) FROM lineitem) l GROUP BY 1""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded per table of the manifest."""
    root = fresh_path(spark, "sheets")
    write_sheets(derived_sheets(spark, sf_dir), root)
    read = read_csv_sheets(spark, root, MANIFEST, GRAMMAR, partitioned=True)
    return load_report(ingest(read, store=True, specs=MANIFEST), MANIFEST).drop("error")


@query("""
SELECT 'pedidos' AS archivo, o_orderstatus AS hoja, CAST(87 AS BIGINT) AS columnas,
       CAST(60 AS BIGINT) AS validas, CAST(27 AS BIGINT) AS filtradas FROM orders GROUP BY 2
UNION ALL SELECT 'envios', l_returnflag, 87, 60, 27 FROM lineitem GROUP BY 2""", name="column_accounting")
def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns per sheet: three that are no period and two years beyond the suffix bound go."""
    grammar = replace(GRAMMAR, max_suffix=4)
    sheets = derived_sheets(spark, sf_dir, extra=("Total", "", "Mayo"))
    rows = rows_from_text(spark, sheets, grammar=grammar)
    headers = rows.groupBy("archivo", "hoja").agg(F.first("etiquetas").alias("etiquetas"))
    return column_accounting(headers, "etiquetas", grammar, by=("archivo", "hoja"))


@query(f"""
SELECT tabla, concepto, CAST(row_number() OVER (PARTITION BY tabla, concepto ORDER BY anio, mes_num) AS INTEGER)
         AS lugar, valor
FROM ({ORDER_CELLS}) c""")
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell grid: every non-empty cell with its column, here numbered within its row."""
    read = rows_from_text(spark, orders_sheets(spark, sf_dir), grammar=GRAMMAR)
    rows = read.select(
        "tabla", F.get("celdas", F.lit(0)).alias("concepto"), "celdas"
    )
    cells = explode_cells(rows).where(F.col("col_idx") > 0)
    # One row of a sheet: as many cells as it has columns.
    row = Window.partitionBy("tabla", "concepto").orderBy("col_idx")
    return cells.select(
        "tabla", "concepto", F.row_number().over(row).alias("lugar"),
        F.col("cell").cast("double").alias("valor"),
    )


@query("""
SELECT o_orderpriority, count(*) AS filas, 'pedidos' AS tabla FROM orders GROUP BY 1""")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, replace with another schema, read back, list."""
    location = fresh_path(spark, "tables")
    store = TableStore(spark, "tabla_" + location[-12:], location)
    orders = table(spark, sf_dir, "orders")
    store.write(orders.groupBy("o_orderstatus").count(), "pedidos")
    counted = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("filas"))
    store.write(counted, "pedidos")
    return store.read("pedidos").crossJoin(F.broadcast(store.names()))


BANDS = Thresholds(2.0e6, 1.7e6)
SURVEY = Survey(
    "encuesta", "libro_empleo", "libro_informalidad", "tablas de prueba",
    grammar=GRAMMAR, thresholds=BANDS, exact=2,
)



def survey_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six sheets of a survey, each aggregated from the tables."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    flag = F.col("l_returnflag")
    sectors = lines.withColumns({
        "_sheet": F.lit(SHEET_SECTOR),
        "_concept": F.when((flag == "R") & (F.col("l_linestatus") == "F"), SECTOR_UNKNOWN)
        .otherwise(F.concat(flag, F.col("l_linestatus"))),
    })
    levels = lines.withColumns({
        "_sheet": F.lit(SHEET_EDUCATION),
        "_concept": F.when(flag == "A", LEVELS.primary).when(flag == "N", LEVELS.secondary)
        .otherwise(LEVELS.high),
    })
    # Orders fold to (customer, month) before they meet the customers, so that a customer with
    # a third of all orders is a few rows when joined.
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    by_customer = orders.groupBy("o_custkey", month.alias("_month")).agg(
        fixed_sum(F.col("o_totalprice"), 2).alias("_value")
    )
    cities = (
        by_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({
            "_sheet": F.lit(SHEET_CITY),
            "_concept": F.when(F.col("n_nationkey") == 3, CITY_AGGREGATE).otherwise(F.col("n_name")),
        })
    )
    first, second = SURVEY.employment_book, SURVEY.informality_book
    order_values, line_values = ("o_orderdate", "o_totalprice"), ("l_shipdate", "l_extendedprice")

    def of_orders(sheet: str, book: str, concept: str, quarter: bool) -> DataFrame:
        named = orders.withColumn("_sheet", F.lit(sheet))
        return sheet_files(named, book, "_sheet", concept, *order_values, 12, quarter)

    sheets = [
        of_orders(SHEET_NATIONAL, first, "o_orderpriority", False),
        sheet_files(sectors, first, "_sheet", "_concept", *line_values, 13),
        of_orders(SHEET_NATIONAL, second, "o_orderpriority", True),
        sheet_files(cities, second, "_sheet", "_concept", "_month", "_value", 12, True),
        of_orders(SHEET_SEX, second, "o_orderstatus", True),
        sheet_files(levels, second, "_sheet", "_concept", *line_values, 12, True),
    ]
    result = sheets[0]
    for sheet in sheets[1:]:
        result = result.unionByName(sheet)
    return result


def _inventory_sql() -> str:
    def count(layer: int, name: str, body: str) -> str:
        return f"SELECT '{LAYERS[layer]}' AS capa, '{name}' AS tabla, count(*) AS num_filas FROM ({body}) t"

    month, line_month = "date_trunc('month', o_orderdate)", "date_trunc('month', l_shipdate)"
    prio = f"SELECT DISTINCT o_orderpriority, {month} FROM orders"
    flags = f"SELECT DISTINCT l_returnflag, l_linestatus, {line_month} FROM lineitem"
    known = f"{flags} WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')"
    city = f"""SELECT DISTINCT c_nationkey, {month} FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey"""
    sex = f"SELECT DISTINCT o_orderstatus, {month} FROM orders"
    level = f"SELECT DISTINCT l_returnflag, {line_month} FROM lineitem"
    cities = f"SELECT DISTINCT c_nationkey FROM ({city}) c WHERE c_nationkey <> 3"
    dashboard = f"""SELECT DISTINCT year(o_orderdate), 'a', 'b' FROM orders
      UNION ALL SELECT DISTINCT year(o_orderdate), 'c', o_orderstatus FROM orders
      UNION ALL SELECT DISTINCT year(l_shipdate), 'd', l_returnflag FROM lineitem"""
    code = SURVEY.code
    return " UNION ALL ".join([
        count(0, f"bronze_{code}_total_nacional", prio),
        count(0, f"bronze_{code}_ocupados_rama_actividad", flags),
        count(0, "bronze_informalidad_total_nacional", prio),
        count(0, "bronze_informalidad_ciudades", city),
        count(0, "bronze_informalidad_sexo", sex),
        count(0, "bronze_informalidad_educacion", level),
        count(1, f"silver_{code}_total_nacional", prio),
        count(1, f"silver_{code}_ocupados_rama", known),
        count(1, "silver_informalidad_total_nacional", prio),
        count(1, "silver_informalidad_ciudades", city),
        count(1, "silver_informalidad_sexo", sex),
        count(1, "silver_informalidad_educacion", level),
        count(2, "gold_metricas_empleo_anual", "SELECT DISTINCT year(o_orderdate), o_orderpriority FROM orders"),
        count(2, "gold_empleo_top_ramas", f"""SELECT DISTINCT year(l_shipdate), l_returnflag, l_linestatus
          FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')"""),
        count(2, "gold_dashboard_informalidad", dashboard),
        count(3, "gold_perfil_ciudades_ml", cities),
        count(3, "gold_recomendaciones_focalizacion", cities),
    ])


def refreshed_store(spark: SparkSession, sf_dir: str) -> TableStore:
    """A full refresh of the survey derived from the tables."""
    root, location = fresh_path(spark, "sheets"), fresh_path(spark, "tables")
    write_sheets(survey_sheets(spark, sf_dir), root)
    store = TableStore(spark, "encuesta_" + location[-12:], location)
    read = read_csv_sheets(spark, root, SURVEY.sheets(), GRAMMAR, partitioned=True)
    refresh(store, read, SURVEY, "prueba")
    return store


@query(_inventory_sql())
def refresh_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all seventeen tables after a full refresh."""
    return ordered_inventory(inventory(refreshed_store(spark, sf_dir), SURVEY))


def monthly_sql(concept: str, date: str, value: str, source: str, where: str = "") -> str:
    """Cells of one sheet: the sum per concept and month."""
    return f"""SELECT {concept} AS c, year({date}) AS y, month({date}) AS m, sum({money_sql(value)}) AS v
    FROM {source} {where} GROUP BY ALL"""


def of_orders_sql(concept: str) -> str:
    return monthly_sql(concept, "o_orderdate", "o_totalprice", "orders")


LEVEL_SQL = f"""CASE l_returnflag WHEN 'A' THEN '{LEVELS.primary}' WHEN 'N' THEN '{LEVELS.secondary}'
  ELSE '{LEVELS.high}' END"""
LEVELS_SQL = monthly_sql(LEVEL_SQL, "l_shipdate", "l_extendedprice", "lineitem")
RATE = "tasa_informalidad_promedio"


@query(f"""
WITH s AS ({of_orders_sql('o_orderpriority')})
SELECT CAST(y AS INTEGER) AS anio, c AS indicador, {mean_sql('v')} AS promedio_anual,
       {round_sql('min(v)')} AS valor_minimo, {round_sql('max(v)')} AS valor_maximo,
       {round_sql('stddev_samp(CAST(v AS DOUBLE))')} AS desviacion_estandar, count(*) AS num_observaciones
FROM s GROUP BY y, c""")
def refresh_annual_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly metrics as the full refresh stores them."""
    return refreshed_store(spark, sf_dir).read("gold_metricas_empleo_anual")


@query(f"""
WITH s AS ({monthly_sql('l_returnflag || l_linestatus', 'l_shipdate', 'l_extendedprice', 'lineitem',
                        "WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')")})
SELECT CAST(y AS INTEGER) AS anio, c AS rama_actividad, {mean_sql('v')} AS promedio_ocupados_miles,
       {sum_sql('v')} AS total_ocupados_miles, count(*) AS num_observaciones FROM s GROUP BY y, c""")
def refresh_top_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top sectors as the full refresh stores them; there are fewer than ten here."""
    return refreshed_store(spark, sf_dir).read("gold_empleo_top_ramas")


@query(f"""
WITH n AS ({of_orders_sql('o_orderpriority')}), s AS ({of_orders_sql('o_orderstatus')}), e AS ({LEVELS_SQL})
SELECT CAST(y AS INTEGER) AS anio, 'Total Nacional' AS dimension, 'General' AS categoria, {mean_sql('v')} AS {RATE}
FROM n GROUP BY y
UNION ALL SELECT CAST(y AS INTEGER), 'Sexo', c, {mean_sql('v')} FROM s GROUP BY y, c
UNION ALL SELECT CAST(y AS INTEGER), 'Nivel Educativo', c, {mean_sql('v')} FROM e GROUP BY y, c""")
def refresh_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard as the full refresh stores it."""
    return refreshed_store(spark, sf_dir).read("gold_dashboard_informalidad")


CITY_SOURCE = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


@query(f"""
WITH c AS ({monthly_sql('n_name', 'o_orderdate', 'o_totalprice', CITY_SOURCE, 'WHERE n_nationkey <> 3')}),
e AS (SELECT c, {mean_sql('v')} AS v FROM ({LEVELS_SQL}) l GROUP BY c),
i AS (SELECT {round_sql(f"""max(CASE WHEN c = '{LEVELS.primary}' THEN v END)
        + max(CASE WHEN c = '{LEVELS.secondary}' THEN v END)""", 0)} / 2 AS low,
        max(CASE WHEN c = '{LEVELS.high}' THEN v END) AS high FROM e),
p AS (SELECT c AS ciudad, {mean_sql('v')} AS {VALUE}, {round_sql('min(v)')} AS tasa_informalidad_min,
        {round_sql('max(v)')} AS tasa_informalidad_max, count(*) AS num_observaciones FROM c GROUP BY c),
f AS (SELECT p.*, {round_sql('low / nullif(high, 0)')} AS {INDEX}, low AS tasa_informalidad_baja_educacion,
        high AS tasa_informalidad_alta_educacion, {band_sql(VALUE, BANDS)} AS severidad_informalidad
      FROM p CROSS JOIN i)
SELECT *, {label_sql()} AS instrumento_recomendado, severidad_informalidad AS prioridad,
       {REASON_SQL} AS justificacion FROM f""")
def refresh_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations as the full refresh stores them."""
    return refreshed_store(spark, sf_dir).read("gold_recomendaciones_focalizacion")


@query(f"""
WITH c AS ({monthly_sql('n_name', 'o_orderdate', 'o_totalprice', CITY_SOURCE, 'WHERE n_nationkey <> 3')})
SELECT c AS ciudad, {mean_sql('v')} AS {VALUE} FROM c GROUP BY c ORDER BY 2 DESC, 1 LIMIT 10""")
def sql_text_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table queried by its name in SQL text."""
    name = refreshed_store(spark, sf_dir).full_name("gold_recomendaciones_focalizacion")
    return spark.sql(f"SELECT ciudad, {VALUE} FROM {name} ORDER BY {VALUE} DESC, ciudad LIMIT 10")
