"""Bronze fed from a growing folder of CSV sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.periods import DEFAULT_GRAMMAR, PeriodGrammar
from ..sources.csv_sheets import headed_from_text, sheet_texts
from ..sources.manifest import SheetRead, SheetSpec, manifest_frame, no_sheets
from ..sources.slices import SLICE, SliceStore
from ..sources.tables import ingest


def ingest_new_sheets(
    spark: SparkSession,
    root: str,
    specs: Sequence[SheetSpec],
    target: str,
    checkpoint: str,
    grammar: PeriodGrammar = DEFAULT_GRAMMAR,
    partitioned: bool = False,
) -> StreamingQuery:
    """Load all sheets that are new since the last call, then stop.

    A file is read once, so a new version of a sheet comes as a new file: in another delivery
    folder above its workbook, or as another file of its partition folder. Each batch replaces
    the slices (workbook, sheet) it brings, also by nothing, so a repeated batch leaves the same
    rows; a sheet it could not read stays as it was and goes to ``<target>_errores``, one slice per
    batch. Sheets are read whole; those above the split size belong to ``snapshots.load_changes``,
    which also sees files that are rewritten in place or gone.
    """
    stream = spark.readStream.format("text").option("wholetext", "true")
    files = sheet_texts(stream, root, partitioned).select(
        "archivo", "hoja", "value",
        F.col("_metadata.file_modification_time").alias("_llegada"),
        F.col("_metadata.file_path").alias("_ruta"),
        F.col("_metadata.file_size").alias("_longitud"),
    )

    def replace_slices(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        newest = newest_versions(batch)
        rows = headed_from_text(newest.select(*SLICE, "value"), manifest_frame(session, specs), grammar)
        done = ingest(SheetRead(rows, no_sheets(session)), store=True)
        errors = done.quarantine.withColumn("lote", F.lit(batch_id))
        errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote").parquet(f"{target}_errores")
        bad = done.quarantine.select(*SLICE).distinct()
        brought = newest.join(F.broadcast(manifest_frame(session, specs)), list(SLICE), "left_semi").select(
            *SLICE, F.col("_ruta").alias("ruta"), F.col("_longitud").alias("longitud"),
            F.col("_llegada").alias("modificado"), F.lit(None).cast("string").alias("huella"))
        unread = bad.withColumnsRenamed({"archivo": "_archivo_origen", "hoja": "_hoja_origen"})
        good = done.bronze.join(unread, ["_archivo_origen", "_hoja_origen"], "left_anti").select(*done.bronze.columns)
        SliceStore(session, target).publish(good, brought.join(bad, list(SLICE), "left_anti"), bad.where(F.lit(False)))

    return (
        files.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(replace_slices)
        .start()
    )


def newest_versions(files: DataFrame) -> DataFrame:
    """Of several files with the same sheet in one batch, the one that came last."""
    version = F.struct("_llegada", "_ruta")
    last = files.groupBy("archivo", "hoja").agg(F.max(version).alias("_version"))
    wanted = last.select("archivo", "hoja", "_version._llegada", "_version._ruta")
    kept = files.join(wanted, ["archivo", "hoja", "_llegada", "_ruta"], "left_semi")
    return kept


def stored_bronze(spark: SparkSession, target: str) -> DataFrame:
    return SliceStore(spark, target).rows()
