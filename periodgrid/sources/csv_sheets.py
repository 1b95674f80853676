"""Sheets exported as CSV, ``<root>/<workbook>/<sheet>.csv`` or partition folders.

Files up to ``WHOLE_FILE_BYTES`` are read as one text each: the header is in the same row as its
lines, so nothing is joined or shuffled. Larger files are read line by line in splits, so that one
giant sheet is spread over many tasks; which lines belong together is told by the parity of quotes,
counted per split and carried over the split borders. Both readers follow the same rules:

- a line break in a quoted cell ends no record, in titles and headers as well as in the body, and
  reads as one ``\n`` however the file spells it; a line end at the end of a file opens no record;
- the rows to skip are records; the record after them is the header;
- a sheet with an odd number of quotes, or with no record left for a header, is unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..functions.headers import promote_header
from ..functions.periods import DEFAULT_GRAMMAR, PeriodGrammar
from ..functions.text import once
from ..operators.joins import BROADCAST_BYTES, fits_broadcast
from ..session import cut_lineage
from .manifest import (
    HEADED_COLUMNS,
    SheetRead,
    SheetSpec,
    decoded_path,
    manifest_frame,
    missing_sheets,
    row_order,
    sheet_of,
    workbook_of,
)

WHOLE_FILE_BYTES = 64 * 1024 * 1024
STRETCH_BYTES = 128 * 1024 * 1024

TORN = "unbalanced quotes"
HEADLESS = "no header row below the skipped rows"

_FIELD = r',("[^"]*+(?:""[^"]*+)*+"(?=,|$)|[^,]*+)'
_RECORD = r'([^"\n]*+(?:"[^"]*+"[^"\n]*+)*+)\n'
_LINE_END = r"\r\n|\r"
_BYTE_ORDER_MARK = "\ufeff"


def split_fields(line: Column) -> Column:
    """One CSV record to its cells; quoted cells may hold commas and doubled quotes."""
    matched = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    unquoted = F.transform(
        matched,
        lambda cell: F.when(
            cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1),
            F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )
    return F.when(line.contains('"'), unquoted).otherwise(F.split(line, ","))


def quote_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def plain_line_ends(text: Column) -> Column:
    """A whole file as the line reader sees it: no byte order mark and one kind of line end."""
    plain = F.when(text.contains("\r"), F.regexp_replace(text, _LINE_END, "\n")).otherwise(text)
    return F.regexp_replace(plain, f"^{_BYTE_ORDER_MARK}", "")


def split_records(text: Column) -> Column:
    """A text with plain line ends to its records; a line break inside a quoted cell does not end
    one. Behind a last line end stands an empty record, as in ``record_count``."""
    quoted = F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(_RECORD), F.lit(1))
    return F.when(text.contains('"'), quoted).otherwise(F.split(text, "\n"))


def record_count(records: Column) -> Column:
    """How many records there are; a line end at the end of a file opens none."""
    return F.size(records) - F.when(F.element_at(records, -1) == "", 1).otherwise(0)


def sheet_texts(
    reader: DataFrameReader | DataStreamReader, root: str, partitioned: bool
) -> DataFrame:
    """Text records with ``archivo`` and ``hoja``, from a batch or a stream reader.

    ``partitioned``: the sheets lie in folders ``archivo=<workbook>/hoja=<sheet>`` as Spark
    writes them, and only folders a query asks for are listed.
    """
    if partitioned:
        return reader.schema("value string, archivo string, hoja string").load(root)
    files = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    path = decoded_path(F.col("_metadata.file_path"))
    return files.load(root).withColumns({"archivo": workbook_of(path), "hoja": sheet_of(path)})


def _text(
    spark: SparkSession, root: str, whole: bool, partitioned: bool, only: Sequence[str] | None = None
) -> DataFrame:
    reader = spark.read.format("text").option("wholetext", str(whole).lower())
    texts = sheet_texts(reader, root, partitioned)
    return texts if only is None else texts.where(F.col("_metadata.file_path").isin(*only))


def headed_from_text(
    files: DataFrame, manifest: DataFrame, grammar: PeriodGrammar = DEFAULT_GRAMMAR
) -> DataFrame:
    """Headed rows from records ``(archivo, hoja, value)`` that each hold a whole sheet."""
    listed = files.join(F.broadcast(manifest), ["archivo", "hoja"])
    listed = listed.select("archivo", "hoja", "tabla", "saltar", once(plain_line_ends(F.col("value"))).alias("value"))
    torn = quote_count(F.col("value")) % 2 == 1
    records = F.col("_records")
    checked = listed.select(
        "archivo", "hoja", "tabla", "saltar",
        once(F.when(~torn, split_records(F.col("value")))).alias("_records"),
    ).withColumn(
        "error",
        F.when(records.isNull(), TORN).when(record_count(records) <= F.col("saltar"), HEADLESS),
    )
    below = F.slice(records, F.col("saltar") + 2, F.greatest(record_count(records) - F.col("saltar") - 1, F.lit(0)))
    sheets = checked.select(
        "archivo", "hoja", "tabla", "error",
        F.when(F.col("error").isNull(), split_fields(F.get(records, F.col("saltar")))).alias("_header"),
        F.when(F.col("error").isNull(), below).otherwise(F.array(F.lit(""))).alias("_body"),
    )
    rows = promote_header(sheets, F.col("_header"), grammar).select(
        "archivo", "hoja", "tabla", "etiquetas", "periodos", "error",
        F.posexplode("_body").alias("_pos", "_line"),
    )
    return rows.select(
        *HEADED_COLUMNS[:5],
        row_order(F.lit(0), F.col("_pos")),
        split_fields(F.col("_line")).alias("celdas"),
        "error",
    )


def _split_states(lines: DataFrame) -> DataFrame:
    """One row per split of a file: is its first byte inside quotes, and the records before it.

    Only lines with an odd number of quotes switch between inside and outside. Their alternating
    sum of positions is the number of lines that begin inside quotes, so a split is told by its
    own odd lines, and a running sum over the splits of a file tells the rest. Stored.
    """
    split, last = ["_ruta", "_block"], F.col("_first") + F.col("_lines") - 1
    nth = F.row_number().over(Window.partitionBy(*split).orderBy("_pos"))
    signed = F.when(F.col("_nth") % 2 == 0, F.col("_pos")).otherwise(-F.col("_pos"))
    odd = lines.where(F.col("_odd") == 1).select(*split, "_pos", nth.alias("_nth"))
    inside = odd.groupBy(*split).agg(F.sum(signed).alias("_inside"))
    sizes = lines.groupBy(*split).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_lines"), F.sum("_odd").alias("_odds"))
    in_file = Window.partitionBy("_ruta").orderBy("_block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    filled = sizes.join(inside, split, "left").withColumns({
        "_inside": F.coalesce("_inside", F.lit(0)) + F.when(F.col("_odds") % 2 == 1, last).otherwise(0),
        "_state": F.coalesce(F.sum("_odds").over(before), F.lit(0)) % 2,
    })
    opened = F.when(F.col("_state") == 0, F.col("_lines") - F.col("_inside")).otherwise(F.col("_inside"))
    counted = filled.withColumn("_opened", opened)
    return cut_lineage(counted.withColumn("_base", F.coalesce(F.sum("_opened").over(before), F.lit(0))))


def _beside(side: DataFrame) -> DataFrame:
    """A stored side of a join, broadcast if it is small."""
    return F.broadcast(side) if fits_broadcast(side, BROADCAST_BYTES) else side


def records_of_lines(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """``_ruta, _record, _block, value``: the records of each file, numbered from 0.

    Lines of a split without odd lines are told by the split alone and do not move; other splits
    are put in order one by one. Only the lines of records with line breaks are brought together.
    """
    known = splits.select("_ruta", "_block", "_first", "_odds", "_state", "_base")
    placed = lines.join(_beside(known), ["_ruta", "_block"])
    at_rest = placed.where(F.col("_odds") == 0).withColumns({
        "_before": F.col("_state"),
        "_record": F.col("_base") + F.when(F.col("_state") == 0, F.col("_pos") - F.col("_first")).otherwise(-1),
    })
    so_far = Window.partitionBy("_ruta", "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    switched = placed.where(F.col("_odds") > 0).withColumn(
        "_before", (F.col("_state") + F.sum("_odd").over(so_far) - F.col("_odd")) % 2)
    moving = switched.withColumn("_record", F.col("_base") + F.sum(1 - F.col("_before")).over(so_far) - 1)
    every = at_rest.unionByName(moving).select("_ruta", "_record", "_block", "_pos", "value", (
        (F.col("_before") == 0) & (F.col("_odd") == 0)).alias("_whole"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_pos", "value")))
    joined = every.where(~F.col("_whole")).groupBy("_ruta", "_record").agg(pieces.alias("_pieces")).select(
        "_ruta", "_record", F.col("_pieces")[0]["_block"].alias("_block"),
        F.concat_ws("\n", F.transform("_pieces", lambda piece: piece["value"])).alias("value"))
    return every.where("_whole").select("_ruta", "_record", "_block", "value").unionByName(joined)


def _headed_from_lines(lines: DataFrame, manifest: DataFrame, grammar: PeriodGrammar) -> DataFrame:
    """Headed rows of sheets too large for one text.

    The place of a line depends on how the files were split, which a second scan may do
    differently, so the lines are stored once and everything follows from that.
    """
    sheet, wanted = ("archivo", "hoja"), manifest.select("archivo", "hoja").distinct()
    stored = cut_lineage(lines.join(F.broadcast(wanted), list(sheet), "left_semi"))
    splits = _split_states(stored)
    sizes = stored.groupBy("_ruta", *sheet).agg(F.first("_size").alias("_size"))
    totals = splits.groupBy("_ruta").agg((F.sum("_odds") % 2).alias("_open"), F.sum("_opened").alias("_records"))
    files = cut_lineage(
        sizes.join(totals, "_ruta").join(F.broadcast(manifest), list(sheet)).select(
            "_ruta", *sheet, "tabla", "saltar", "_size",
            F.when(F.col("_open") == 1, TORN).when(F.col("_records") <= F.col("saltar"), HEADLESS).alias("error"))
    )
    readable = files.where(F.col("error").isNull())
    # A torn file has no records to speak of; its lines are not put together.
    sound = stored.join(_beside(files.where("error IS NULL").select("_ruta").distinct()), "_ruta", "left_semi")
    records = records_of_lines(sound, splits)

    top = records.join(_beside(readable), "_ruta").where(F.col("_record") == F.col("saltar"))
    promoted = promote_header(top, split_fields(F.col("value")), grammar)
    headers = cut_lineage(promoted.select("_ruta", *sheet, "tabla", "saltar", "_size", "etiquetas", "periodos"))
    if fits_broadcast(headers, BROADCAST_BYTES):
        joined = records.join(F.broadcast(headers.drop("_size")), "_ruta")
    else:
        stretches = F.sequence(F.lit(0), F.floor(F.col("_size") / STRETCH_BYTES).cast("int"))
        spread = headers.withColumn("_stretch", F.explode(stretches)).drop("_size")
        stretch = F.floor(F.col("_block") / STRETCH_BYTES).cast("int")
        joined = records.withColumn("_stretch", stretch).join(spread, ["_ruta", "_stretch"])
    rows = joined.where(F.col("_record") > F.col("saltar")).select(
        *HEADED_COLUMNS[:5],
        row_order(F.col("_block"), F.col("_record")),
        split_fields(F.col("value")).alias("celdas"),
        F.lit(None).cast("string").alias("error"),
    )
    unread = files.where(F.col("error").isNotNull()).select(*sheet, "tabla", "error")
    return rows.unionByName(unread, allowMissingColumns=True)


def read_csv_sheets(
    spark: SparkSession,
    root: str,
    specs: Sequence[SheetSpec],
    grammar: PeriodGrammar = DEFAULT_GRAMMAR,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    partitioned: bool = False,
    only: Sequence[str] | None = None,
) -> SheetRead:
    """All listed sheets below ``root`` as headed rows, in one job; ``only`` restricts the files
    by their paths, as ``file_listing`` spells them."""
    manifest = manifest_frame(spark, specs)
    size = F.col("_metadata.file_size")

    # The size filter prunes whole files, so each branch opens only its own.
    whole = _text(spark, root, True, partitioned, only).where(size <= whole_file_bytes)
    rows = headed_from_text(whole.select("archivo", "hoja", "value"), manifest, grammar)

    listed = file_listing(spark, root, partitioned, only=only)
    if not listed.where(F.col("longitud") > whole_file_bytes).isEmpty():
        lines = _text(spark, root, False, partitioned, only).where(size > whole_file_bytes).select(
            "archivo", "hoja", "value",
            size.alias("_size"),
            F.col("_metadata.file_path").alias("_ruta"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
            (quote_count(F.col("value")) % 2).alias("_odd"),
        )
        rows = rows.unionByName(_headed_from_lines(lines, manifest, grammar))
    return SheetRead(rows, missing_sheets(manifest, listed, ("archivo", "hoja")))


def file_listing(
    spark: SparkSession, root: str, partitioned: bool, more: Sequence[str] = (), only: Sequence[str] | None = None
) -> DataFrame:
    """``archivo, hoja, ruta, longitud, modificado`` of every file; contents are not read unless
    ``more`` asks for ``content``."""
    reader = spark.read.format("binaryFile")
    if partitioned:
        files = reader.load(root)
    else:
        path = decoded_path(F.col("_metadata.file_path"))
        files = (
            reader.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv")
            .load(root)
            .withColumns({"archivo": workbook_of(path), "hoja": sheet_of(path)})
        )
    ruta = F.col("_metadata.file_path")
    if only is not None:
        files = files.where(ruta.isin(*only))
    names = [F.col(name).cast("string") for name in ("archivo", "hoja")]
    return files.select(
        *names, ruta.alias("ruta"), F.col("length").alias("longitud"), F.col("modificationTime").alias("modificado"), *more)


def sheet_catalog(spark: SparkSession, root: str, partitioned: bool = False) -> DataFrame:
    """``archivo, numero, hoja`` of every sheet, numbered from 1 within its workbook."""
    within = Window.partitionBy("archivo").orderBy("hoja")
    names = file_listing(spark, root, partitioned)
    return names.select("archivo", F.row_number().over(within).alias("numero"), "hoja")
