"""Gold that follows changed sheets: states per slice, made once per load and merged on read.

Beside the rows of each load (see ``sources.slices``) lie the states of its slices. A load that
brings three sheets costs the states of three sheets; the metrics of all years and concepts are
merged from states, of which there are a few per concept and sheet, not from the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators.states import annual_from_states, mean_from_states, merge_states, partial_states
from ..session import child_names, path_exists
from ..sources.slices import SliceStore

GROUP = ("tabla", "anio", "concepto")


class GoldStates:
    """States of the slices of a store. ``prepare`` turns Bronze rows into those that count (by
    default rows with a date), ``exact`` is the number of decimals of the values, if fixed."""

    def __init__(self, store: SliceStore, prepare: Callable[[DataFrame], DataFrame] | None = None, exact: int | None = None):
        self.store, self.exact = store, exact
        self.prepare = prepare or (lambda rows: rows.where(F.col("fecha").isNotNull()))
        self.folder = f"{store.path}/estados"

    def _made(self) -> set[int]:
        names = [name for name in child_names(self.store.spark, self.folder) if name.partition("=")[2].isdigit()]
        return {int(n.partition("=")[2]) for n in names if path_exists(self.store.spark, f"{self.folder}/{n}/_SUCCESS")}

    def update(self) -> list[int]:
        """Make the states of loads that have none yet; returns their versions."""
        new = sorted(set(self.store.versions()) - self._made())
        for version in new:
            rows = self.prepare(self.store.version_rows(version))
            states = partial_states(rows, ("_archivo", "_hoja", *GROUP), exact=self.exact)
            # A few states per sheet; a folder left by a failed run is replaced.
            states.write.mode("overwrite").parquet(f"{self.folder}/version={version}")
        return new

    def current(self) -> DataFrame:
        """States of the slices that count now."""
        used = self.store.versions()
        spark = self.store.spark
        if not used:
            nothing = self.prepare(self.store.no_rows())
            return partial_states(nothing, ("_archivo", "_hoja", *GROUP), exact=self.exact)
        read = [spark.read.parquet(f"{self.folder}/version={v}").withColumn("version", F.lit(v)) for v in used]
        states = read[0]
        for more in read[1:]:
            states = states.unionByName(more)
        pointers = self.store.pointers().select("version", F.col("archivo").alias("_archivo"), F.col("hoja").alias("_hoja"))
        return states.join(F.broadcast(pointers), ["version", "_archivo", "_hoja"], "left_semi")

    def annual_metrics(self) -> DataFrame:
        """``tabla, anio, concepto`` and the yearly metrics."""
        return annual_from_states(merge_states(self.current(), GROUP), GROUP, self.exact)

    def yearly_means(self, name: str = "promedio") -> DataFrame:
        """``tabla, anio`` and the mean over all concepts."""
        return mean_from_states(self.current(), ("tabla", "anio"), name, self.exact)
