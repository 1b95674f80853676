"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning is what lets the same code run on 60 thousand and on 10^11 rows:
# small partitions are merged, hot join partitions are split, and a join side is
# broadcast only after its real size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "periodgrid", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` only for local work, a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is made only for a local master with nothing configured.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="periodgrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), "periodgrid", f"{label}-{uuid.uuid4().hex}")


def sql_literal(value: str | int | float | date | None) -> str:
    """A Python value as SQL text: one parsed expression instead of many driver calls."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def local_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A few literal rows as a local relation, whose expressions Spark folds without a job."""
    lines = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(columns)})")


def cut_lineage(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that later stages survive lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)
