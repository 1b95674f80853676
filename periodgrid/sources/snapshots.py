"""What changed in a folder of sheets since the last load: new, changed, gone.

The list of pointers of a ``SliceStore`` says which file each slice was read from, how long it was,
when it was written and a digest of its content. A load compares that with the folder as it is
now. Files with the same length and time are not opened; of the others the digest decides, so a
file that was only touched or copied is not loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import DEFAULT_GRAMMAR, PeriodGrammar
from ..session import cut_lineage
from .csv_sheets import WHOLE_FILE_BYTES, file_listing, read_csv_sheets
from .manifest import SheetRead, SheetSpec, manifest_frame, no_sheets
from .slices import SLICE, SliceStore
from .tables import ingest

NEW, CHANGED, GONE, SAME = "nueva", "cambiada", "retirada", "igual"


def current_files(spark: SparkSession, root: str, specs: Sequence[SheetSpec], partitioned: bool = False) -> DataFrame:
    """``archivo, hoja, ruta, longitud, modificado``: of each listed sheet the file written last."""
    listed = file_listing(spark, root, partitioned)
    wanted = manifest_frame(spark, specs).select(*SLICE).distinct()
    version = F.max(F.struct("modificado", "ruta", "longitud")).alias("_v")
    last = listed.join(F.broadcast(wanted), list(SLICE), "left_semi").groupBy(*SLICE).agg(version)
    return last.select(*SLICE, "_v.ruta", "_v.longitud", "_v.modificado")


def _digests(spark: SparkSession, root: str, paths: Sequence[str], partitioned: bool, whole_file_bytes: int) -> DataFrame:
    """``ruta, huella`` of the given files; longer ones than the limit have none, so their length
    and time decide."""
    files = file_listing(spark, root, partitioned, ("content",), paths).where(F.col("longitud") <= whole_file_bytes)
    return files.select("ruta", F.sha2("content", 256).alias("huella"))


def differences(
    spark: SparkSession, root: str, specs: Sequence[SheetSpec], known: DataFrame, partitioned: bool = False,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """``archivo, hoja, cambio`` and the present file of each slice that is there or was; stored."""
    before = known.select(*SLICE, *[F.col(n).alias(f"_{n}") for n in ("ruta", "longitud", "modificado", "huella")])
    now = current_files(spark, root, specs, partitioned)
    both = cut_lineage(now.join(before, list(SLICE), "full"))
    alike = (F.col("longitud") == F.col("_longitud")) & (F.col("modificado") == F.col("_modificado")) & (F.col("ruta") == F.col("_ruta"))
    open_ = both.where(F.col("ruta").isNotNull() & ~F.coalesce(alike, F.lit(False)))
    # Names of files to read: the driver holds the names of all files of the folder anyway.
    paths = [row.ruta for row in open_.select("ruta").collect()]
    digests = _digests(spark, root, paths, partitioned, whole_file_bytes)
    seen = both.join(digests, "ruta", "left").withColumn("huella", F.when(alike, F.col("_huella")).otherwise(F.col("huella")))
    kind = (
        F.when(F.col("ruta").isNull(), GONE)
        .when(F.col("_ruta").isNull(), NEW)
        .when(alike | (F.col("huella") == F.col("_huella")), SAME)
        .otherwise(CHANGED)
    )
    return cut_lineage(seen.select(*SLICE, kind.alias("cambio"), "ruta", "longitud", "modificado", "huella"))


def load_changes(
    spark: SparkSession, root: str, specs: Sequence[SheetSpec], target: str, grammar: PeriodGrammar = DEFAULT_GRAMMAR,
    partitioned: bool = False, whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Bring the slices of ``target`` up to the folder. Returns ``archivo, hoja, cambio, error``.

    Only new and changed files are read. A version that cannot be read leaves the slice as it was
    and is tried again by the next load; a sheet whose file is gone loses its rows.
    """
    store = SliceStore(spark, target)
    found = differences(spark, root, specs, store.pointers(), partitioned, whole_file_bytes)
    fresh = found.where(F.col("cambio").isin(NEW, CHANGED))
    paths = [row.ruta for row in fresh.select("ruta").collect()]
    gone = found.where(F.col("cambio") == GONE)
    errors = no_sheets(spark)
    if paths:
        read = read_csv_sheets(spark, root, specs, grammar, whole_file_bytes, partitioned, only=paths)
        done = ingest(SheetRead(read.rows, no_sheets(spark)), store=True)
        errors = done.quarantine
        bad = errors.select(*SLICE).distinct()
        good = fresh.join(bad, list(SLICE), "left_anti")
        # One sheet can feed several tables: if it fails for one of them, it stays as it was for all.
        lineage = bad.withColumnsRenamed({"archivo": "_archivo_origen", "hoja": "_hoja_origen"})
        rows = done.bronze.join(lineage, ["_archivo_origen", "_hoja_origen"], "left_anti").select(*done.bronze.columns)
        store.publish(rows, good, gone)
    elif not gone.isEmpty():
        store.publish(store.rows().where(F.lit(False)), fresh, gone)
    reasons = errors.groupBy(*SLICE).agg(F.min("error").alias("error"))
    return found.select(*SLICE, "cambio").join(reasons, list(SLICE), "left")
