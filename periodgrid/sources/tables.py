"""Bronze ingest and table storage."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.reshape import headed_rows_to_long
from ..session import child_names, cut_lineage, delete_path, local_rows, path_exists
from .manifest import SheetRead, SheetSpec, manifest_frame


def with_lineage(rows: DataFrame, archive: Column, sheet: Column) -> DataFrame:
    """Append source file, source sheet and load time."""
    return rows.withColumns({
        "_archivo_origen": archive,
        "_hoja_origen": sheet,
        "_fecha_carga": F.current_timestamp(),
    })


#: What tells one sheet of a load: its table, its file and its name.
SHEET_KEY = ("tabla", "archivo", "hoja")


@dataclass(frozen=True)
class Ingest:
    """Long rows of all sheets with lineage, and what could not be read.

    ``bronze`` is ``tabla, concepto, anio, ..., valor`` and the lineage columns; ``quarantine``
    is ``tabla, archivo, hoja, error``.
    """

    bronze: DataFrame
    quarantine: DataFrame
    #: Rows and least error per manifest line, as the write of the outcome saw them.
    seen: tuple[tuple[int, str | None], ...] | None = None


def _line(spec: SheetSpec) -> Column:
    return (F.col("tabla") == spec.table) & (F.col("archivo") == spec.workbook) & (F.col("hoja") == spec.sheet)


def _observed(long: DataFrame, specs: Sequence[SheetSpec]) -> tuple[DataFrame, tuple[tuple[int, str | None], ...]]:
    """The rows stored, and what the write saw of each manifest line."""
    seen, error = Observation(), F.col("error")
    counts = [F.count_if(_line(spec) & error.isNull()).alias(f"n{i}") for i, spec in enumerate(specs)]
    errors = [F.min(F.when(_line(spec), error)).alias(f"e{i}") for i, spec in enumerate(specs)]
    stored = cut_lineage(long.observe(seen, *counts, *errors), partition_by=("tabla",))
    return stored, tuple((seen.get[f"n{i}"], seen.get[f"e{i}"]) for i in range(len(specs)))


def ingest(read: SheetRead, store: bool = False, specs: Sequence[SheetSpec] = ()) -> Ingest:
    """Sheets to long rows. ``store`` writes the outcome once, so that the files are read once
    however often rows and errors are used; each table is then a folder of the stored result.
    With ``specs`` that write counts the rows of each line, which the load report then takes."""
    long = headed_rows_to_long(read.rows, ("tabla", "archivo", "hoja", "error"), "error")
    seen = None
    if store and specs:
        long, seen = _observed(long, specs)
    elif store:
        long = cut_lineage(long, partition_by=("tabla",))
    errors = long.where(F.col("error").isNotNull()).select("tabla", "archivo", "hoja", "error").distinct()
    # A sheet with an error counts as unread: the rows before the error are no table.
    unread = errors.select(*SHEET_KEY).distinct()
    good = long.where(F.col("error").isNull()).join(unread, list(SHEET_KEY), "left_anti").select(*long.columns)
    bronze = with_lineage(good, F.col("archivo"), F.col("hoja")).drop("archivo", "hoja", "error")
    return Ingest(bronze, errors.unionByName(read.missing), seen)


def table_rows(bronze: DataFrame, spec: SheetSpec) -> DataFrame:
    """The rows of one Bronze table, its concept under the table's own name."""
    return bronze.where(F.col("tabla") == spec.table).drop("tabla").withColumnRenamed(
        "concepto", spec.concept
    )


def load_report(done: Ingest, specs: Sequence[SheetSpec]) -> DataFrame:
    """``tabla, filas, columnas, cargada, error`` per manifest line: the rows and the error of its
    own sheet. A sheet is loaded if it gave rows and no error."""
    width = len(done.bronze.columns) - 1
    key = list(SHEET_KEY)
    if done.seen is not None:
        # A line without rows and errors is one for which no sheet was found, or an empty sheet.
        lines = [(s.table, s.workbook, s.sheet, 0 if e else n, width, e) for s, (n, e) in zip(specs, done.seen)]
        told = local_rows(done.bronze.sparkSession, (*key, "filas", "columnas", "_seen"), lines)
        found = done.quarantine.groupBy(*key).agg(F.min("error").alias("_missing")) if any(not n and not e for n, e in done.seen) else None
        reason = F.col("_seen") if found is None else F.coalesce("_seen", "_missing")
        told = told if found is None else told.join(found, key, "left")
        return told.select(
            "tabla", F.col("filas").cast("bigint").alias("filas"), "columnas",
            ((F.col("filas") > 0) & reason.isNull()).alias("cargada"), reason.cast("string").alias("error"))
    listed = manifest_frame(done.bronze.sparkSession, specs).select(*key)
    of_sheet = done.bronze.withColumnsRenamed({"_archivo_origen": "archivo", "_hoja_origen": "hoja"})
    counts = of_sheet.groupBy(*key).agg(F.count(F.lit(1)).alias("filas"))
    errors = done.quarantine.groupBy(*key).agg(F.min("error").alias("error"))
    filled = F.coalesce("filas", F.lit(0))
    return (
        listed.join(counts, key, "left")
        .join(errors, key, "left")
        .select(
            "tabla", filled.alias("filas"), F.lit(width).alias("columnas"),
            ((filled > 0) & F.col("error").isNull()).alias("cargada"), "error",
        )
    )


def clustered(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows dealt to files by ranges of ``columns`` and sorted in them, so that a filter on the first
    of them opens few files and few row groups. How many files there are is left to Spark."""
    return rows.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else rows


class TableStore:
    """Tables of one catalog schema, kept below one folder of shared storage.

    A table is replaced by pointer: the new rows are written to a folder of their own, and only
    when they are whole does the catalog entry move there. A reader sees the old version or the
    new one, a failed write leaves the old one, and a table may be made from its own rows. The
    version before stays for those who are reading it; older ones go. The number of rows is
    counted by the write itself and kept as a table property.
    """

    ROWS_PROPERTY = "periodgrid.filas"

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None):
        self.spark, self.schema = spark, schema
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{place}")
        self.location = spark.catalog.getDatabase(schema).locationUri.rstrip("/")

    def full_name(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def write(
        self, rows: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
        order_by: Sequence[str] = (),
    ) -> None:
        """Replace a table, schema included (``overwrite``), add rows to it (``append``), or replace
        those partitions that ``rows`` has rows for (``partitions``). ``order_by`` clusters what is
        written; the order of rows read back is no property of a table."""
        rows = clustered(rows, order_by)
        if mode == "overwrite" or not self.exists(name):
            path, count = self._stage(rows, name, partition_by)
            self._publish(name, path, count, self._fields(rows, partition_by), partition_by)
            return
        table = self.full_name(name)
        ordered = rows.select(*self.read(name).columns)
        if mode == "partitions":
            whole = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            whole.partitionBy(*partition_by).parquet(self._pointer(name))
            self.spark.catalog.recoverPartitions(table)
            self.spark.catalog.refreshTable(table)
        else:
            ordered.write.mode("append").insertInto(table)
        self.spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{self.ROWS_PROPERTY}')")

    def write_bucketed(self, rows: DataFrame, name: str, columns: Sequence[str], buckets: int) -> None:
        """Replace a table by one whose rows lie in ``buckets`` files by the hash of ``columns``: tables
        with the same buckets are joined and grouped by them without moving a row."""
        path, seen = f"{self._versions(name)}/{uuid.uuid4().hex}", Observation()
        # The rows are written through an entry of their own, which then goes and leaves its files.
        entry = f"{self.schema}.{name}_{uuid.uuid4().hex}"
        dealt = rows.observe(seen, F.count(F.lit(1)).alias("filas")).repartition(buckets, *columns)
        try:
            dealt.write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(entry)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        keys = ", ".join(f"`{column}`" for column in columns)
        layout = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
        self._publish(name, path, seen.get["filas"], self._fields(rows), layout=layout)

    def write_all(
        self, tables: Mapping[str, DataFrame], at_once: int = 4, order_by: Mapping[str, Sequence[str]] | None = None
    ) -> None:
        """Replace several tables, a few at a time. No table moves before the rows of all are
        written, so a failure leaves all of them as they were."""

        @inheritable_thread_target(self.spark)
        def one(item: tuple[str, DataFrame]) -> tuple[str, str, int]:
            return item[0], *self._stage(clustered(item[1], (order_by or {}).get(item[0], ())), item[0], ())

        with ThreadPoolExecutor(at_once) as pool:
            staged = list(pool.map(one, tables.items()))
        for name, path, count in staged:
            self._publish(name, path, count, self._fields(tables[name]))

    @staticmethod
    def _fields(rows: DataFrame, partition_by: Sequence[str] = ()) -> list[tuple[str, str]]:
        """Names and types, the columns of partitions last as the catalog has them."""
        return sorted(rows.dtypes, key=lambda field: list(partition_by).index(field[0]) if field[0] in partition_by else -1)

    def _versions(self, name: str) -> str:
        return f"{self.location}/{name}.versiones"

    def _stage(self, rows: DataFrame, name: str, partition_by: Sequence[str]) -> tuple[str, int]:
        """Write rows to a folder that no table points to. Returns it and the rows written."""
        path = f"{self._versions(name)}/{uuid.uuid4().hex}"
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("filas")).write.partitionBy(*partition_by).parquet(path)
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} was not written to its end")
        return path, seen.get["filas"]

    def _publish(
        self, name: str, path: str, count: int, fields: list[tuple[str, str]], partition_by: Sequence[str] = (),
        layout: str = "",
    ) -> None:
        table, before = self.full_name(name), None
        if self.exists(name):
            before = self._pointer(name)
            plain = not partition_by and not layout and not self._laid_out(name)
            alike = plain and self.read(name).dtypes == fields
            # Columns belong to the catalog entry: if they change it is made anew; no rows are touched.
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'" if alike else f"DROP TABLE {table}")
        if not self.exists(name):
            columns = ", ".join(f"`{column}` {kind}" for column, kind in fields)
            parts = f" PARTITIONED BY ({', '.join(f'`{column}`' for column in partition_by)})" if partition_by else ""
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts}{layout} LOCATION '{path}'")
            if partition_by:
                self.spark.catalog.recoverPartitions(table)
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{self.ROWS_PROPERTY}' = '{count}')")
        self.spark.catalog.refreshTable(table)
        keep = {path.rsplit("/", 1)[-1], (before or "").rsplit("/", 1)[-1]}
        for folder in child_names(self.spark, self._versions(name)):
            if folder not in keep:
                delete_path(self.spark, f"{self._versions(name)}/{folder}")

    def _described(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}").collect()
        return {row.col_name: row.data_type for row in rows}

    def _pointer(self, name: str) -> str:
        return self._described(name).get("Location", "").rstrip("/")

    def _laid_out(self, name: str) -> bool:
        return not {"# Partition Information", "Num Buckets"}.isdisjoint(self._described(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def rows_written(self, name: str) -> int | None:
        """The rows of a table as its last write counted them; None if rows were added since."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(name)}").collect()
        return next((int(row.value) for row in found if row.key == self.ROWS_PROPERTY), None)

    def names(self) -> DataFrame:
        """``tabla`` of every table, as the catalog lists them."""
        return self.spark.sql(f"SHOW TABLES IN {self.schema}").select(
            F.col("tableName").alias("tabla")
        )
