"""Bronze in slices (one sheet of one workbook each) that are replaced one by one.

Every load writes the slices it brings under a version of its own and then a new list of pointers:
which version of which slice counts. Rows are what the last whole list points to. So a load that
fails changes nothing, a reader never meets half a load, and a slice can become empty or go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import delete_path, child_names, path_exists

ROWS_SCHEMA = (
    "concepto string, anio int, mes string, mes_num int, fecha date, periodo string, valor double, "
    "_archivo_origen string, _hoja_origen string, _fecha_carga timestamp, "
    "version int, tabla string, _archivo string, _hoja string"
)
POINTER_SCHEMA = (
    "archivo string, hoja string, ruta string, longitud bigint, modificado timestamp, huella string, version int"
)
SLICE = ("archivo", "hoja")


class SliceStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _lists(self) -> list[int]:
        """Versions whose list of pointers is whole, in rising order."""
        found = [name.partition("=")[2] for name in child_names(self.spark, f"{self.path}/punteros")]
        return sorted(int(v) for v in found if v.isdigit() and path_exists(self.spark, f"{self._list(int(v))}/_SUCCESS"))

    def _list(self, version: int) -> str:
        return f"{self.path}/punteros/version={version}"

    def pointers(self) -> DataFrame:
        """The current version of each slice and the file it was read from."""
        lists = self._lists()
        if not lists:
            return self.spark.createDataFrame([], POINTER_SCHEMA)
        return self.spark.read.schema(POINTER_SCHEMA).parquet(self._list(lists[-1]))

    def next_version(self) -> int:
        """A version that no load has used, failed ones included."""
        used = [name.partition("=")[2] for folder in ("punteros", "filas") for name in child_names(self.spark, f"{self.path}/{folder}")]
        return 1 + max((int(v) for v in used if v.isdigit()), default=0)

    def versions(self) -> list[int]:
        """Versions that something points to: at most one per load."""
        return sorted(row.version for row in self.pointers().select("version").distinct().collect())

    def no_rows(self) -> DataFrame:
        return self.spark.createDataFrame([], ROWS_SCHEMA)

    def version_rows(self, *versions: int) -> DataFrame:
        """All rows that these loads wrote, also those that nothing points to any more. Folders of
        other loads are not even listed."""
        folder = f"{self.path}/filas"
        read = self.spark.read.schema(ROWS_SCHEMA).option("basePath", folder)
        return read.parquet(*[f"{folder}/version={version}" for version in versions])

    def rows(self) -> DataFrame:
        """Current rows: ``tabla``, the long columns and the lineage."""
        used = self.versions()
        current = self.pointers().select("version", F.col("archivo").alias("_archivo"), F.col("hoja").alias("_hoja"))
        stored = self.version_rows(*used) if used else self.no_rows()
        columns = [name for name in stored.columns if name not in ("version", "_archivo", "_hoja")]
        return stored.join(F.broadcast(current), ["version", "_archivo", "_hoja"], "left_semi").select(*columns)

    def publish(self, rows: DataFrame, loaded: DataFrame, gone: DataFrame) -> int:
        """Replace the slices of ``loaded`` (the pointer columns but for ``version``) by ``rows`` and
        take away those of ``gone`` (``archivo, hoja``). Rows of other slices must not be among
        ``rows``; a loaded slice without rows becomes empty."""
        version = self.next_version()
        sliced = rows.withColumns({"_archivo": F.col("_archivo_origen"), "_hoja": F.col("_hoja_origen")})
        sliced.write.partitionBy("tabla", "_archivo", "_hoja").parquet(f"{self.path}/filas/version={version}")
        fresh = loaded.select(*SLICE, "ruta", "longitud", "modificado", "huella").withColumn("version", F.lit(version))
        touched = loaded.select(*SLICE).unionByName(gone.select(*SLICE))
        kept = self.pointers().join(touched, list(SLICE), "left_anti").select(*fresh.columns)
        kept.unionByName(fresh).coalesce(1).write.parquet(self._list(version))
        return version

    def vacuum(self) -> None:
        """Delete rows and states that the current list does not point to, and all older lists."""
        lists = self._lists()
        if not lists:
            return
        used = {row.version for row in self.pointers().select("version").distinct().collect()}
        for name in child_names(self.spark, f"{self.path}/filas"):
            if name.partition("=")[2].isdigit() and int(name.partition("=")[2]) not in used:
                for kind in ("filas", "estados"):
                    delete_path(self.spark, f"{self.path}/{kind}/{name}")
        for version in lists[:-1]:
            delete_path(self.spark, self._list(version))
