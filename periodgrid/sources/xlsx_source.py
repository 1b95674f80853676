"""Sheets of xlsx workbooks as a data source: ``spark.read.format("period_xlsx")``.

The directory at the end of a zip names its parts, so planning reads a few kilobytes per workbook
and makes one task per (workbook, sheet). A task reads its own sheet and the texts and styles that
all sheets share; other sheets of the book are not read. Rows leave a task in chunks that carry
their header once (see ``xlsx_sheets``).

Options: ``path`` (root folder), ``wanted`` (JSON: workbook -> list of [sheet, records to skip]),
or ``catalog`` = ``true`` for the names of all sheets. Files are opened by the Arrow file system
of the path's scheme; ``reachable`` tells whether there is one.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .xlsx_sheets import CHUNKS, CHUNK_DDL, NAMES, NAMES_DDL, sheet_chunks, sheet_parts

FORMAT = "period_xlsx"
#: Zip directories read at a time while a read is planned.
AT_ONCE = 32


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(f"file://{path[len('file:'):]}" if path.startswith("file:/") and path[6:7] != "/" else path)


def reachable(path: str) -> bool:
    """Can tasks open files below ``path`` themselves? If not, only Spark's own readers can."""
    try:
        files, inside = located(path)
        return files.get_file_info(inside).type == fs.FileType.Directory
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def workbooks(root: str) -> list[str]:
    """Paths of all workbooks below ``root``."""
    files, inside = located(root)
    found = files.get_file_info(fs.FileSelector(inside, recursive=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.endswith(".xlsx") and f.base_name[0] not in "._")


class _Stream(io.RawIOBase):
    """An Arrow file as the standard library expects one: a place outside it is an ``OSError``."""

    def __init__(self, source: pa.NativeFile):
        self.source = source

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.source.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            self.source.seek(offset, whence)
        except pa.ArrowInvalid as wrong:
            raise OSError(str(wrong)) from wrong
        return self.source.tell()

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


@contextmanager
def opened(files: fs.FileSystem, path: str) -> Iterator[zipfile.ZipFile]:
    with files.open_input_file(path) as source, zipfile.ZipFile(io.BufferedReader(_Stream(source), 1 << 16)) as book:
        yield book


class XlsxReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.catalog = options.get("catalog", "false") == "true"
        self.wanted = {name: [tuple(sheet) for sheet in sheets] for name, sheets in json.loads(options.get("wanted", "{}")).items()}

    def partitions(self) -> list[InputPartition]:
        """One task per workbook and sheet that is wanted; a book that cannot be read is one task."""
        files, _ = located(self.root)
        paths = [p for p in workbooks(self.root) if self.catalog or p.rsplit("/", 1)[-1] in self.wanted]

        def tasks(path: str) -> list[tuple]:
            name = path.rsplit("/", 1)[-1]
            try:
                with opened(files, path) as book:
                    parts = sheet_parts(book)
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, OSError) as problem:
                reason = f"{type(problem).__name__}: {problem}"
                return [(path, name, sheet, 0, skip, reason) for sheet, skip in ([] if self.catalog else self.wanted[name])]
            if self.catalog:
                return [(path, name, sheet, number, 0, None) for number, (sheet, _) in enumerate(parts, 1)]
            known = {sheet for sheet, _ in parts}
            return [(path, name, sheet, 0, skip, None if sheet in known else "sheet not found") for sheet, skip in self.wanted[name]]

        with ThreadPoolExecutor(AT_ONCE) as pool:
            found = [task for book in pool.map(tasks, paths) for task in book]
        if self.catalog:
            # Nothing is left to read: the names are the result, so one task gives them out.
            found = [(None, None, None, 0, 0, json.dumps([(name, number, sheet) for _, name, sheet, number, _, _ in found]))]
        return [InputPartition(task) for task in found] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, name, sheet, _, skip, problem = partition.value
        if self.catalog:
            rows = [dict(zip(NAMES.names, row)) for row in json.loads(problem)]
            yield pa.RecordBatch.from_pylist(rows, schema=NAMES)
        elif problem is not None:
            yield pa.RecordBatch.from_pylist([{"archivo": name, "hoja": sheet, "saltar": skip, "error": problem}], schema=CHUNKS)
        else:
            files, _ = located(self.root)
            try:
                with opened(files, path) as book:
                    for chunk in sheet_chunks(name, book, {(sheet, skip)}):
                        yield pa.RecordBatch.from_pylist([chunk], schema=CHUNKS)
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, OSError) as wrong:
                reason = f"{type(wrong).__name__}: {wrong}"
                yield pa.RecordBatch.from_pylist([{"archivo": name, "hoja": sheet, "saltar": skip, "error": reason}], schema=CHUNKS)


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return NAMES_DDL if self.options.get("catalog", "false") == "true" else CHUNK_DDL

    def reader(self, schema) -> XlsxReader:
        return XlsxReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)
