"""States merge to what one pass gives, and follow changed slices."""

import math
import random
import statistics

import pytest

from periodgrid.operators.gold import annual_metrics
from periodgrid.operators.states import annual_from_states, mean_from_states, merge_states, partial_states
from periodgrid.plans.incremental_gold import GoldStates
from periodgrid.sources.manifest import SheetSpec
from periodgrid.sources.slices import SliceStore
from periodgrid.sources.snapshots import load_changes

BY = ("anio", "indicador")


def facts(spark, n=600, scale=1.0, offset=0.0):
    rng = random.Random(4)
    rows = [(rng.choice([2021, 2022, None]), rng.choice(["a", "b", "c", None]), None if rng.random() < 0.1 else round(offset + rng.gauss(0, 50) * scale, 2),
             rng.randint(0, 6), "2021-01-01") for _ in range(n)]
    rows += [(2030, "one", 1.25, 0, "2021-01-01"), (2030, "none", None, 1, "2021-01-01")]
    return spark.createDataFrame(rows, "anio int, indicador string, valor double, hoja int, fecha string")


@pytest.mark.parametrize("exact", [None, 2])
def test_merged_states_equal_one_pass(spark, rows_of, exact):
    rows = facts(spark)
    states = partial_states(rows, ("hoja", *BY), exact=exact)
    merged = merge_states(states, BY)
    full = annual_metrics(rows, exact=exact)
    assert rows_of(annual_from_states(merged, BY, exact), *full.columns) == rows_of(full)
    # Merging in two steps is merging at once.
    halves = partial_states(rows, ("hoja", *BY), exact=exact).withColumn("mitad", states.hoja % 2)
    twice = merge_states(merge_states(halves, ("mitad", *BY)), BY)
    assert rows_of(annual_from_states(twice, BY, exact)) == rows_of(annual_from_states(merged, BY, exact))
    assert rows_of(mean_from_states(states, ("anio",), "m", exact)) == rows_of(mean_from_states(merged, ("anio",), "m", exact))


def test_deviations_far_from_zero(spark):
    """Values of 10^9 with deviations of 1: sums of squares would lose them all."""
    rows = facts(spark, 2000, 0.02, 1e9)
    got = {(r.anio, r.indicador): math.sqrt(r._m2 / (r._n - 1)) for r in merge_states(partial_states(rows, ("hoja", *BY)), BY).collect() if r._n > 1}
    for key, deviation in got.items():
        values = [r.valor for r in rows.collect() if (r.anio, r.indicador) == key and r.valor is not None]
        assert deviation == pytest.approx(statistics.stdev(values), rel=1e-6)


def test_only_new_loads_are_aggregated(spark, tmp_path, rows_of):
    folder = tmp_path / "in" / "libro"
    folder.mkdir(parents=True)
    specs = [SheetSpec("libro", name, f"t{name}", "c", 0) for name in "abc"]

    def load(**sheets):
        for name, text in sheets.items():
            (folder / f"{name}.csv").write_text(text)
        load_changes(spark, str(tmp_path / "in"), specs, str(tmp_path / "out"))
        states = GoldStates(SliceStore(spark, str(tmp_path / "out")))
        made = states.update()
        return made, rows_of(states.annual_metrics(), "tabla", "concepto", "promedio_anual", "num_observaciones")

    assert GoldStates(SliceStore(spark, str(tmp_path / "out"))).annual_metrics().count() == 0
    first = load(a="k,Ene,Feb\nx,1,3\n", b="k,Ene\ny,5\n")
    assert first == ([1], [("ta", "x", 2.0, 2), ("tb", "y", 5.0, 1)])
    assert load() == ([], first[1])
    assert load(a="k,Ene,Feb\nx,1,\n", c="k,Ene\nz,7\n") == ([2], [("ta", "x", 1.0, 1), ("tb", "y", 5.0, 1), ("tc", "z", 7.0, 1)])
    assert load(b="k,Ene\ny,\n") == ([3], [("ta", "x", 1.0, 1), ("tc", "z", 7.0, 1)])  # emptied
    store = SliceStore(spark, str(tmp_path / "out"))
    store.vacuum()
    assert rows_of(GoldStates(store).yearly_means(), "tabla", "promedio") == [("ta", 1.0), ("tc", 7.0)]
