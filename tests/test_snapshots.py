"""Loads that follow a folder: new, changed, emptied, touched, broken and gone sheets."""

import os

import pytest

from periodgrid.sources.manifest import SheetSpec
from periodgrid.sources.slices import SliceStore
from periodgrid.sources.snapshots import load_changes

SPECS = [SheetSpec("libro", name, f"t{name}", "c", 1) for name in ("1", "b", "c")] + [SheetSpec("libro", "b", "otra", "c", 1)]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "libro").mkdir(parents=True)

    def put(name, *lines, age=0):
        path = tmp_path / "in" / "libro" / f"{name}.csv"
        path.write_text("\n".join(["título", "k,Ene", *lines]))
        os.utime(path, (1_700_000_000 + age,) * 2)
        return path

    return put


@pytest.fixture(params=[1 << 20, 0])
def load(request, spark, tmp_path, rows_of):
    """One load; its report and the rows after it."""
    def run():
        report = load_changes(spark, str(tmp_path / "in"), SPECS, str(tmp_path / "out"), whole_file_bytes=request.param)
        found = rows_of(report, "hoja", "cambio", "error")
        rows = SliceStore(spark, str(tmp_path / "out")).rows()
        return found, rows_of(rows, "tabla", "concepto", "valor")

    return run


def test_loads_follow_the_folder(load, folder):
    folder("1", "x,1")
    folder("b", "y,2", "z,3")
    first = [("otra", "y", 2.0), ("otra", "z", 3.0), ("t1", "x", 1.0), ("tb", "y", 2.0), ("tb", "z", 3.0)]
    assert load() == ([("1", "nueva", None), ("b", "nueva", None)], first)
    assert load() == ([("1", "igual", None), ("b", "igual", None)], first)
    # The same path and length, other content; a new sheet; a sheet emptied.
    folder("1", "x,9", age=5)
    folder("b", "y,", age=5)
    folder("c", "w,4")
    third = [("t1", "x", 9.0), ("tc", "w", 4.0)]
    assert load() == ([("1", "cambiada", None), ("b", "cambiada", None), ("c", "nueva", None)], third)
    # A version that cannot be read leaves the last good one, and is tried again.
    folder("1", 'x,"1', age=9)
    broken = ([("1", "cambiada", "unbalanced quotes"), ("b", "igual", None), ("c", "igual", None)], third)
    assert load() == broken and load() == broken
    folder("c").unlink()
    folder("1", "x,9", age=12)
    assert load()[1] == [("t1", "x", 9.0)]
    assert load()[0] == [("1", "igual", None), ("b", "igual", None)]


def test_touched_files_are_not_loaded_again(spark, tmp_path, folder):
    path = folder("1", "x,1")
    run = lambda: [r.cambio for r in load_changes(spark, str(tmp_path / "in"), SPECS, str(tmp_path / "out")).collect()]
    assert run() == ["nueva"]
    os.utime(path, (1_800_000_000,) * 2)
    assert run() == ["igual"]
    folder("c", "w,4")
    (tmp_path / "in" / "copia" / "libro").mkdir(parents=True)
    (tmp_path / "in" / "copia" / "libro" / "c.csv").write_text("título\nk,Ene\nw,5")
    assert sorted(run()) == ["igual", "nueva"]  # of two files of one sheet the one written last counts
    rows = SliceStore(spark, str(tmp_path / "out")).rows()
    assert {r.valor for r in rows.collect()} == {1.0, 5.0}


def test_a_failed_load_changes_nothing(spark, tmp_path, folder, rows_of, monkeypatch):
    target = str(tmp_path / "out")
    folder("1", "x,1")
    folder("b", "y,2")
    load_changes(spark, str(tmp_path / "in"), SPECS, target)
    before = rows_of(SliceStore(spark, target).rows())
    folder("1", "x,7", age=3)
    # The rows are written, the list of pointers is not.
    real = SliceStore.pointers
    calls = []

    def failing(self):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("lost")
        return real(self)

    monkeypatch.setattr(SliceStore, "pointers", failing)
    with pytest.raises(OSError):
        load_changes(spark, str(tmp_path / "in"), SPECS, target)
    monkeypatch.undo()
    store = SliceStore(spark, target)
    assert rows_of(store.rows()) == before and store.next_version() == 3
    load_changes(spark, str(tmp_path / "in"), SPECS, target)
    assert rows_of(store.rows(), "tabla", "valor") == [("otra", 2.0), ("t1", 7.0), ("tb", 2.0)]
    store.vacuum()
    assert sorted(os.listdir(tmp_path / "out" / "filas")) == ["version=1", "version=3"]
    assert rows_of(store.rows(), "tabla", "valor") == [("otra", 2.0), ("t1", 7.0), ("tb", 2.0)]


def test_only_current_folders_are_opened(spark, tmp_path, folder):
    folder("1", "x,1")
    folder("b", "y,2")
    for value in range(3):
        folder("c", f"w,{value}", age=value)
        load_changes(spark, str(tmp_path / "in"), SPECS, str(tmp_path / "out"))
    rows = SliceStore(spark, str(tmp_path / "out")).rows()
    assert rows.count() == 4
    read = [f.split("/filas/version=")[1].split("/")[0] for f in rows.inputFiles() if "/filas/" in f]
    assert sorted(read) == ["1"] * 4 + ["3"]
