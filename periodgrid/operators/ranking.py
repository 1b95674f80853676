"""Top-k and exact ranks without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .joins import join_hot_keys


def top_k(rows: DataFrame, value: str, key: str | Sequence[str], k: int = 10) -> DataFrame:
    """The k largest by value, ties by key: each partition keeps k rows, then they merge."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows.orderBy(F.col(value).desc(), *[F.col(name).asc() for name in keys]).limit(k)


def rank_descending(
    rows: DataFrame, value: str, name: str = "puesto", buckets: int = 256
) -> DataFrame:
    """SQL ``rank()`` by ``value`` descending (NULL last), without one big window.

    Equal values are merged into one counted row first. The distinct values fall into
    buckets cut at approximate quantiles, which the driver holds as ``buckets`` numbers; a
    rank is then (rows in higher buckets) + (rows above within the bucket) + 1. The cut points
    only balance the work: any cut points give the same ranks.
    """
    missing, filled = F.col(value).isNull().alias("_missing"), F.coalesce(F.col(value), F.lit(0))
    keyed = rows.select("*", missing, filled.alias("_key"))
    # The counted values are stored, not the rows: cut points and ranks both read them.
    counts = cut_lineage(keyed.groupBy("_missing", "_key").agg(F.count(F.lit(1)).alias("_n")))

    steps = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(counts.approxQuantile("_key", steps, 0.25 / buckets)))
    bounds = F.array(*[F.lit(float(cut)) for cut in cuts]).cast("array<double>")
    above = F.size(F.filter(bounds, lambda cut: cut > F.col("_key")))
    last = F.lit(len(cuts) + 1)
    bucketed = counts.withColumn("_bucket", F.when(F.col("_missing"), last).otherwise(above))

    sizes = bucketed.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy("_bucket")
        .orderBy(F.col("_key").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rank = F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1
    # One row per bucket, so at most ``buckets`` + 1 rows are broadcast.
    ranked = bucketed.join(F.broadcast(offsets), "_bucket").select(
        "_missing", "_key", rank.alias(name)
    )
    joined = join_hot_keys(keyed, ranked, ["_missing", "_key"])
    return joined.select(*rows.columns, name)


def lag_change(
    rows: DataFrame, value: str, order: str, by: Sequence[str] = (), name: str = "variacion_pp"
) -> DataFrame:
    """Change against the previous period. ``rows`` hold one row per (``by``, period)."""
    series = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn(name, F.col(value) - F.lag(value).over(series))


def share_of_total(
    rows: DataFrame, value: str, by: Sequence[str], name: str = "participacion_pct"
) -> DataFrame:
    """100 * value / total of its group; the totals are joined back, not windowed."""
    totals = rows.groupBy(*by).agg(F.sum(value).alias("_total"))
    share = F.try_divide(F.col(value).cast("double") * 100, F.col("_total").cast("double"))
    # NULL is a group like any other.
    keyed = totals.withColumnsRenamed({key: f"_of_{key}" for key in by})
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in by]
    joined = rows.join(keyed, same) if by else rows.crossJoin(F.broadcast(totals))  # one row
    return joined.select(*rows.columns, share.alias(name))
