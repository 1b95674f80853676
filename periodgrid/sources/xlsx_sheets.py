"""Sheets of xlsx workbooks.

A sheet is one compressed stream and cannot be split, so one task unpacks it (``xlsx_source``);
only the cell texts are taken out there. Headers, periods, numbers and everything after are Spark
expressions. Rows leave the task in chunks that carry their header once, so nothing has to be
joined back. In a store that only Spark's own readers can open, a task unpacks a whole workbook.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.headers import promote_header
from ..functions.periods import DEFAULT_GRAMMAR, PeriodGrammar
from .manifest import (
    HEADED_COLUMNS,
    SheetRead,
    SheetSpec,
    decoded_path,
    manifest_frame,
    missing_sheets,
    row_order,
)

CHUNK_ROWS = 2000

CHUNKS = pa.schema([
    ("archivo", pa.string()), ("hoja", pa.string()), ("saltar", pa.int32()),
    ("encabezado", pa.list_(pa.string())),
    ("primera", pa.int64()), ("filas", pa.list_(pa.list_(pa.string()))), ("error", pa.string()),
])
CHUNK_DDL = (
    "archivo string, hoja string, saltar int, encabezado array<string>, primera bigint, "
    "filas array<array<string>>, error string"
)
NAMES = pa.schema([("archivo", pa.string()), ("numero", pa.int32()), ("hoja", pa.string())])

NAMES_DDL = "archivo string, numero int, hoja string"

# Number formats that the file format defines as dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_EPOCH = datetime(1899, 12, 30)


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part inside the zip) in workbook order."""
    links = {
        link.get("Id"): link.get("Target")
        for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    found = []
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(element) == "sheet":
            link = next(v for k, v in element.attrib.items() if k.endswith("}id"))
            target = links[link]
            found.append((element.get("name"), target[1:] if target[0] == "/" else f"xl/{target}"))
    return found


def _text_of(element) -> str:
    """The text of a string item; phonetic hints are not part of it."""
    if _tag(element) == "t":
        return element.text or ""
    return "".join(_text_of(child) for child in element if _tag(child) != "rPh")


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return [_text_of(item) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    custom, styles = {}, []
    for element in ElementTree.fromstring(book.read("xl/styles.xml")):
        if _tag(element) == "numFmts":
            custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in element}
        if _tag(element) == "cellXfs":
            styles = [int(x.get("numFmtId", 0)) for x in element]

    def is_date(code: int) -> bool:
        bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(code, ""))
        return code in DATE_FORMATS or bool(re.search("[dmyhs]", bare, re.I))

    return {i for i, code in enumerate(styles) if is_date(code)}


def _cell_text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_text_of(child) for child in cell)
    value = next((child.text for child in cell if _tag(child) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "n" and int(cell.get("s", 0)) in dates:
        return (_EPOCH + timedelta(days=float(value))).isoformat(" ")
    return value


def _column(reference: str | None, following: int) -> int:
    """0-based column of a reference such as ``AB12``; cells without one follow each other."""
    if not reference:
        return following
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def _sheet_rows(stream, shared: list[str], dates: set[int]) -> Iterator[tuple[int, list]]:
    """(physical row from 0, cells) in file order, one row in memory at a time."""
    expected, parent = 0, None
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start" and _tag(element) == "sheetData":
            parent = element
        if event == "start" or _tag(element) != "row":
            continue
        row = int(element.get("r", expected + 1)) - 1
        cells: list[str | None] = []
        for cell in element:
            if _tag(cell) != "c":
                continue
            at = _column(cell.get("r"), len(cells))
            cells += [None] * (at - len(cells))
            cells.append(_cell_text(cell, shared, dates))
        yield row, cells
        expected = row + 1
        parent.clear()


def sheet_chunks(
    archive: str, book: zipfile.ZipFile, wanted: set[tuple[str, int]]
) -> Iterator[dict]:
    parts = dict(sheet_parts(book))
    shared, dates = _shared_texts(book), _date_styles(book)
    for sheet, skip in sorted(wanted):
        record = {"archivo": archive, "hoja": sheet, "saltar": skip}
        if sheet not in parts:
            yield {**record, "error": "sheet not found"}
            continue
        header, first, rows = None, 0, []
        try:
            with book.open(parts[sheet]) as stream:
                for row, cells in _sheet_rows(stream, shared, dates):
                    if row == skip:
                        header = cells
                    elif row > skip and header is not None:
                        first = first if rows else row
                        rows.append(cells)
                        if len(rows) == CHUNK_ROWS:
                            yield {**record, "encabezado": header, "primera": first, "filas": rows}
                            rows = []
            if header is None:
                yield {**record, "error": "no header row below the skipped rows"}
            elif rows:
                yield {**record, "encabezado": header, "primera": first, "filas": rows}
        except Exception as problem:
            yield {**record, "error": f"{type(problem).__name__}: {problem}"}


def _books(batches) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for archive, content in zip(batch.column("archivo"), batch.column("content")):
            yield archive.as_py(), content.as_py()


def _files(spark: SparkSession, root: str) -> DataFrame:
    path = decoded_path(F.col("_metadata.file_path"))
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xlsx")
        .load(root)
        .select(F.element_at(F.split(path, "/"), -1).alias("archivo"), "content")
    )


def _unpacked_books(spark: SparkSession, root: str, wanted: dict[str, set[tuple[str, int]]]) -> DataFrame:
    """Chunks of the wanted sheets, by Spark's reader of whole files: one task per workbook."""

    def unpack(batches):
        for archive, content in _books(batches):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    for chunk in sheet_chunks(archive, book, wanted[archive]):
                        yield pa.RecordBatch.from_pylist([chunk], schema=CHUNKS)
            except Exception as problem:
                reason = f"{type(problem).__name__}: {problem}"
                bad = [
                    {"archivo": archive, "hoja": sheet, "saltar": skip, "error": reason}
                    for sheet, skip in wanted[archive]
                ]
                yield pa.RecordBatch.from_pylist(bad, schema=CHUNKS)

    return _files(spark, root).where(F.col("archivo").isin(*wanted)).mapInArrow(unpack, CHUNK_DDL)


def sheet_rows(
    spark: SparkSession, root: str, specs: Sequence[SheetSpec], by_sheet: bool | None = None
) -> DataFrame:
    """Chunks of the sheets in ``specs`` below ``root``, a task per sheet where files can be opened
    by the tasks (``by_sheet``: None finds out)."""
    from . import xlsx_source

    wanted: dict[str, set[tuple[str, int]]] = {}
    for spec in specs:
        wanted.setdefault(spec.workbook, set()).add((spec.sheet, spec.skip_rows))
    if by_sheet is None:
        by_sheet = xlsx_source.reachable(root)
    if not by_sheet:
        return _unpacked_books(spark, root, wanted)
    xlsx_source.register(spark)
    listed = json.dumps({name: sorted(sheets) for name, sheets in wanted.items()})
    return spark.read.format(xlsx_source.FORMAT).option("wanted", listed).load(root)


def read_xlsx_sheets(
    spark: SparkSession,
    root: str,
    specs: Sequence[SheetSpec],
    grammar: PeriodGrammar = DEFAULT_GRAMMAR,
    by_sheet: bool | None = None,
) -> SheetRead:
    """All listed sheets of the workbooks below ``root`` as headed rows, in one job."""
    manifest = manifest_frame(spark, specs)
    chunks = sheet_rows(spark, root, specs, by_sheet).join(
        F.broadcast(manifest.select("archivo", "hoja", "saltar", "tabla")),
        ["archivo", "hoja", "saltar"],
    )
    # A sheet that could not be read keeps one empty row, which carries the reason.
    filled = chunks.withColumn(
        "filas", F.coalesce("filas", F.array(F.array().cast("array<string>")))
    )
    rows = promote_header(filled, F.col("encabezado"), grammar).select(
        *HEADED_COLUMNS[:5], "error", "primera", F.posexplode("filas").alias("_i", "celdas")
    )
    placed = rows.select(
        *HEADED_COLUMNS[:5],
        row_order(F.lit(0), F.col("primera") + F.col("_i")),
        "celdas",
        "error",
    )
    return SheetRead(placed, missing_sheets(manifest, _files(spark, root), ("archivo",)))


def sheet_catalog(spark: SparkSession, root: str, by_sheet: bool | None = None) -> DataFrame:
    """``archivo, numero, hoja`` of every sheet, in workbook order; unreadable books have none."""
    from . import xlsx_source

    if xlsx_source.reachable(root) if by_sheet is None else by_sheet:
        xlsx_source.register(spark)
        return spark.read.format(xlsx_source.FORMAT).option("catalog", "true").load(root)

    def names(batches):
        for archive, content in _books(batches):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    found = [name for name, _ in sheet_parts(book)]
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                continue
            rows = [
                {"archivo": archive, "numero": i, "hoja": name} for i, name in enumerate(found, 1)
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=NAMES)

    return _files(spark, root).mapInArrow(names, NAMES_DDL)
