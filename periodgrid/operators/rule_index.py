"""Many threshold rules at once: the first match as a step function, looked up by bucket.

Of all rules of one severity, the first whose bound an index reaches changes only where a bound
brings a rule that stands before all rules with smaller bounds. These change points cut the line
of index values into intervals with one label each. Intervals are spread over equally wide
buckets, and a row meets those of its own bucket, so it is compared with a few intervals however
many rules there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .joins import BROADCAST_BYTES, fits_broadcast
from .rules import MONITORING


def rule_intervals(rules: DataFrame) -> DataFrame:
    """``severidad, desde, hasta, etiqueta``: the label for indexes from ``desde`` (NULL: from the
    least, and for a NULL index) to below ``hasta`` (NULL: to the greatest); stored.

    ``rules`` is ``regla, severidad, minimo, etiqueta``; of rules with one number the smallest
    label counts.
    """
    bounds = rules.where("severidad IS NOT NULL AND regla IS NOT NULL").groupBy("severidad", "minimo").agg(
        F.min(F.struct("regla", "etiqueta")).alias("_first"))
    # One row per bound of a severity: rules, not facts.
    rising = Window.partitionBy("severidad").orderBy(F.col("minimo").asc_nulls_first())
    so_far = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = bounds.withColumn("_best", F.min("_first").over(so_far))
    before = F.lag("_best").over(rising)
    steps = best.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_best") != F.col("_before")))
    until = F.lead("minimo").over(rising)
    return cut_lineage(steps.select("severidad", F.col("minimo").alias("desde"), until.alias("hasta"), F.col("_best.etiqueta").alias("etiqueta")))


def _bucket(value: Column, low: float, high: float, buckets: int) -> Column:
    """0 below ``low``, 1 to ``buckets`` between, one more from ``high`` on; rising with ``value``."""
    width = (high - low) / buckets
    inner = F.floor((value - low) / width).cast("int") + 1 if width > 0 else F.lit(1)
    return F.when(value < low, 0).when(value >= high, buckets + 1).otherwise(F.least(inner, F.lit(buckets)))


def first_match_by_intervals(
    rows: DataFrame,
    rules: DataFrame,
    severity: str = "severidad_informalidad",
    index: str = "indice_vulnerabilidad_educativa",
    name: str = "instrumento_recomendado",
    default: str = MONITORING,
) -> DataFrame:
    """``rows`` with the label of the first rule that holds, for any number of rules.

    The buckets are broadcast if they are small; otherwise both sides meet by severity and bucket,
    and Spark splits a bucket that many rows fall into.
    """
    intervals = rule_intervals(rules)
    one = intervals.agg(F.min("desde").alias("low"), F.max("desde").alias("high"), F.count("desde").alias("n")).first()
    # Infinite and NaN bounds give no width; what lies between finite ones is what buckets are for.
    ends = [e for e in (one.low, one.high) if e is not None and abs(e) < float("inf")]
    low, high = (ends[0], ends[-1]) if len(ends) == 2 and ends[0] < ends[-1] else (0.0, 1.0)
    buckets = max(1, min(one.n, 1 << 20))

    first = F.when(F.col("desde").isNull(), 0).otherwise(_bucket(F.col("desde"), low, high, buckets))
    last = F.when(F.col("hasta").isNull(), buckets + 1).otherwise(_bucket(F.col("hasta"), low, high, buckets))
    # A NULL index has a bucket of its own, which only intervals without a lower end reach.
    covered = F.sequence(F.when(F.col("desde").isNull(), -1).otherwise(first), last)
    spread = cut_lineage(intervals.select(
        F.col("severidad").alias("_severidad"), F.explode(covered).alias("_casilla"),
        F.col("desde").alias("_desde"), F.col("hasta").alias("_hasta"), F.col("etiqueta").alias("_etiqueta")))
    side = F.broadcast(spread) if fits_broadcast(spread, BROADCAST_BYTES) else spread
    x = F.col(index).cast("double")
    placed = rows.withColumn("_x", x).withColumn(
        "_casilla_fila", F.when(F.col("_x").isNull(), -1).otherwise(_bucket(F.col("_x"), low, high, buckets)))
    inside = (
        (F.col(severity) == F.col("_severidad"))
        & (F.col("_casilla_fila") == F.col("_casilla"))
        & (F.col("_desde").isNull() | (F.col("_x") >= F.col("_desde")))
        & (F.col("_hasta").isNull() | F.col("_x").isNull() | (F.col("_x") < F.col("_hasta")))
    )
    label = F.when(F.col("_severidad").isNotNull(), F.col("_etiqueta")).otherwise(F.lit(default))
    return placed.join(side, inside, "left").select(*[F.col(f"`{c}`") for c in rows.columns], label.alias(name))
