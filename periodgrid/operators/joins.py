"""Joins that hold when one key carries a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(side: DataFrame, limit: int) -> bool:
    """Is a stored side small enough to be broadcast? By the size of its files, without a job."""
    size = side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def join_hot_keys(
    facts: DataFrame, small: DataFrame, on: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join of facts with a side that has one row per key; NULL keys match NULL keys.

    The small side is stored, so its size is known: if it is small indeed, it is broadcast and
    the facts do not move. If not, both sides meet on the key; partitions that a hot key makes
    large are split at run time (adaptive skew join), with a copy of the one matching row each.
    """
    side = cut_lineage(small.withColumnsRenamed({name: f"_on_{name}" for name in on}))
    matches = [F.col(name).eqNullSafe(F.col(f"_on_{name}")) for name in on]
    if fits_broadcast(side, broadcast_bytes):
        side = F.broadcast(side)
    return facts.join(side, _all(matches), "inner").drop(*[f"_on_{name}" for name in on])


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def cross_one_row(rows: DataFrame, single: DataFrame) -> DataFrame:
    """Attach a relation that is one row by construction (a global aggregate)."""
    return rows.crossJoin(F.broadcast(single))
