"""Helpers that several operators share: stored steps, Arrow tasks, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as every operator reads it: null is empty."""
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """A step written to the folder all executors share and read back: its lineage ends here."""
    return cut_lineage(df)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {name.lower() for name in df.columns}
    while base in taken:
        base = f"_{base}"
    return base


#: Keys that are sent to every task rather than shuffled with the texts: 8 to 16 bytes each.
BROADCAST_KEYS = 1 << 20


def counted_side(keys: DataFrame) -> DataFrame:
    """A side of a join that has nothing but keys, stored and counted: a side of at most
    ``BROADCAST_KEYS`` is broadcast, so that the texts stay where they are; for a larger one both
    sides are shuffled."""
    keys = stored(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """Stretches of a text column of about ``limit`` bytes, at least one whole text each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield texts.slice(at, to - at)
        at = to


def parts_of(spark: SparkSession) -> int:
    """The number of shuffle partitions, which whoever runs the job sizes with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(src, dst)``: one row (id, component) per node.

    ``component`` is the smallest id reachable. Large-star and small-star steps alternate until
    the edges are stars. Each step is a minimum per node (combined before the shuffle) and a
    join whose hot nodes Spark may split; no component is gathered in one task.
    """
    now = stored(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    for _ in range(rounds):
        after = stored(_small_star(_large_star(now)))
        # Stars only: each node has one centre, and no centre is linked to a smaller node.
        split = after.groupBy("src").count().where("count > 1")
        if after.join(after.select(F.col("src").alias("dst")), "dst", "left_semi").isEmpty() and split.isEmpty():
            break
        now = after
    else:
        raise RuntimeError("components did not settle")
    leaves = after.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("component"))
    return leaves.unionByName(after.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    moved = edges.join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.unionByName(least.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct()
