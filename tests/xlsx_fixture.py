"""A minimal xlsx writer for tests: shared and inline texts, numbers, booleans, sparse cells."""

import zipfile
from xml.sax.saxutils import escape, quoteattr

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def column_name(i):
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def write_workbook(path, sheets, inline=False):
    """``sheets``: name -> rows; a cell is None, str, int, float, bool or ("date", serial)."""
    shared, links, names = [], [], []
    with zipfile.ZipFile(path, "w") as book:
        for number, (name, rows) in enumerate(sheets.items(), 1):
            lines = []
            for r, row in enumerate(rows, 1):
                cells = []
                for c, value in enumerate(row):
                    at = f'r="{column_name(c)}{r}"'
                    if value is None:
                        continue
                    if isinstance(value, str) and inline:
                        cells.append(f'<c {at} t="inlineStr"><is><t>{escape(value)}</t></is></c>')
                    elif isinstance(value, str):
                        shared.append(value)
                        cells.append(f'<c {at} t="s"><v>{len(shared) - 1}</v></c>')
                    elif isinstance(value, bool):
                        cells.append(f'<c {at} t="b"><v>{int(value)}</v></c>')
                    elif isinstance(value, tuple):
                        cells.append(f'<c {at} s="1"><v>{value[1]}</v></c>')
                    else:
                        cells.append(f"<c {at}><v>{value!r}</v></c>")
                if cells:
                    lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            book.writestr(
                f"xl/worksheets/sheet{number}.xml",
                f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
            )
            names.append(f'<sheet name={quoteattr(name)} sheetId="{number}" r:id="rId{number}"/>')
            links.append(f'<Relationship Id="rId{number}" Target="worksheets/sheet{number}.xml"/>')
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{"".join(names)}</sheets></workbook>',
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships>{"".join(links)}</Relationships>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        items = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
