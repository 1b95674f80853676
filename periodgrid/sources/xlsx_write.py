"""Workbooks written by the executors, one task per workbook.

For exports and for tests of the reader: cells that look like numbers become numbers, all others
shared texts. A workbook is one zip file, so it is made in one task; its size is bounded by the
file format, not by the tables.
"""

from __future__ import annotations

import re
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import cut_lineage
from .xlsx_source import located

# The names and parts that the file format prescribes.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_DECLARATION = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_NUMBER = re.compile(r"-?\d+(\.\d+)?([eE][+-]?\d+)?")
#: What XML 1.0 cannot hold.
_FORBIDDEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def column_name(position: int) -> str:
    """``A`` for 0, ``Z`` for 25, ``AA`` for 26."""
    name, position = "", position + 1
    while position:
        position, letter = divmod(position - 1, 26)
        name = chr(65 + letter) + name
    return name


def _sheet_xml(rows: list[list[str | None]], texts: dict[str, int]) -> str:
    lines = []
    for number, row in enumerate(rows, 1):
        cells = []
        for position, text in enumerate(row):
            if not text:
                continue
            place = f"{column_name(position)}{number}"
            if _NUMBER.fullmatch(text):
                cells.append(f'<c r="{place}"><v>{text}</v></c>')
            else:
                cells.append(f'<c r="{place}" t="s"><v>{texts.setdefault(text, len(texts))}</v></c>')
        lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    return f'{_DECLARATION}<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook_parts(sheets: list[tuple[str, list[list[str | None]]]]) -> dict[str, str]:
    """The parts of a workbook by their name within the zip."""
    texts: dict[str, int] = {}
    bodies = {f"xl/worksheets/sheet{k}.xml": _sheet_xml(rows, texts) for k, (_, rows) in enumerate(sheets, 1)}
    listed = "".join(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, (name, _) in enumerate(sheets, 1))
    links = "".join(f'<Relationship Id="rId{k}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    shared = "".join(f'<si><t xml:space="preserve">{escape(_FORBIDDEN.sub("", text))}</t></si>' for text in texts)
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    overrides = "".join(f'<Override PartName="/{name}" ContentType="{kinds}.worksheet+xml"/>' for name in bodies)
    return {
        "[Content_Types].xml": (
            f'{_DECLARATION}<Types xmlns="{_PACKAGE}/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>'
            f'<Override PartName="/xl/sharedStrings.xml" ContentType="{kinds}.sharedStrings+xml"/>{overrides}</Types>'),
        "_rels/.rels": (
            f'{_DECLARATION}<Relationships xmlns="{_PACKAGE}/relationships">'
            f'<Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>'),
        "xl/workbook.xml": f'{_DECLARATION}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": (
            f'{_DECLARATION}<Relationships xmlns="{_PACKAGE}/relationships">{links}'
            f'<Relationship Id="rId{len(sheets) + 1}" Type="{_LINKS}/sharedStrings" Target="sharedStrings.xml"/></Relationships>'),
        "xl/sharedStrings.xml": f'{_DECLARATION}<sst xmlns="{_MAIN}">{shared}</sst>',
        **bodies,
    }


def write_workbooks(sheets: DataFrame, root: str) -> DataFrame:
    """``archivo, hojas`` of the workbooks written below ``root`` (an action).

    ``sheets`` is ``archivo, hoja, filas`` with the cells of a sheet as rows of texts; the sheets
    of a book stand in the order of their names. A file appears under its name when it is whole.
    """

    def write(table: pa.Table) -> pa.Table:
        name = table.column("archivo")[0].as_py()
        rows = sorted(table.select(["hoja", "filas"]).to_pylist(), key=lambda row: row["hoja"])
        files, inside = located(root)
        files.create_dir(inside, recursive=True)
        partial = f"{inside}/_{name}.partial"
        with files.open_output_stream(partial) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as book:
            for part, text in workbook_parts([(row["hoja"], row["filas"]) for row in rows]).items():
                book.writestr(part, text)
        files.move(partial, f"{inside}/{name}")
        return pa.table({"archivo": [name], "hojas": pa.array([len(rows)], pa.int32())})

    done = sheets.select("archivo", "hoja", "filas").groupBy("archivo").applyInArrow(write, "archivo string, hojas int")
    return cut_lineage(done)
