"""Distinct counts that merge: sketches per slice, united when the question is asked.

A count of distinct values cannot be added up over years or sheets; a HyperLogLog sketch can. It is
a column like any other, of a few kilobytes at most, so slices keep theirs and a report over any
set of slices reads sketches, not rows. ``profile.distinct_counts`` stays the exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: 2^LG_K registers: a standard error of about 0.65 %.
LG_K = 14


def distinct_sketches(rows: DataFrame, by: Sequence[str], column: str, lg_k: int = LG_K) -> DataFrame:
    """``by, boceto``: a sketch of the distinct values of ``column`` per group, NULL not counted.

    Values are compared as text, so slices whose columns were typed differently still merge.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(column).cast("string"), lg_k).alias("boceto"))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups; sketches of different sizes unite at the smaller one."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("boceto", True).alias("boceto"))


def estimated(sketches: DataFrame, name: str = "distintos") -> DataFrame:
    """The estimated number of distinct values in place of the sketch."""
    kept = [F.col(c) for c in sketches.columns if c != "boceto"]
    return sketches.select(*kept, F.hll_sketch_estimate("boceto").alias(name))
