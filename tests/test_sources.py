"""Sheets from CSV and xlsx files, quarantine, storage, stream and the whole refresh."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from periodgrid.functions.periods import PeriodGrammar
from periodgrid.plans.layers import LAYERS, Survey
from periodgrid.plans.refresh import inventory, load_bronze, ordered_inventory, refresh
from periodgrid.sources import csv_sheets, xlsx_sheets, xlsx_source
from periodgrid.sources.manifest import SheetSpec
from periodgrid.sources.tables import TableStore, ingest, load_report, table_rows
from periodgrid.sources.xlsx_write import write_workbooks
from periodgrid.streaming.incremental import ingest_new_sheets, stored_bronze
from xlsx_fixture import write_workbook

BOOK = "libro+uno.xlsx"
SPECS = (
    SheetSpec(BOOK, "Educación ", "edu", "nivel", 2),
    SheetSpec(BOOK, "Sexo", "sexo", "sexo", 3),
)
EDU = [
    ["Anexo, título"], [], ["", "Ene", "Feb", "Ene", "Total"], ["x", "1", "2,5", "3", "9"],
    ["", "3", 'a"b', "4"], [], ["p,\nq", "9", "", "N/A", "", "extra"], ["NA", "5"],
]
SEXO = [["t"], ["t"], ["t"], ["k", "Ene - mar", "Ene - mar"], ["Hombres", "1e3", "inf"]]
EXPECTED = sorted([
    ("edu", "x", 2021, "Ene", 1.0), ("edu", "x", 2022, "Ene.1", 3.0), ("edu", None, 2021, "Ene", 3.0),
    ("edu", None, 2022, "Ene.1", 4.0), ("edu", "p,\nq", 2021, "Ene", 9.0), ("edu", None, 2021, "Ene", 5.0),
    ("sexo", "Hombres", 2021, "Ene - mar", 1000.0), ("sexo", "Hombres", 2022, "Ene - mar.1", float("inf")),
], key=repr)


def csv_line(cells):
    return ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') else c for c in cells)


def write_csv(root, book, sheet, rows, end="\n"):
    folder = root / book
    folder.mkdir(exist_ok=True)
    (folder / f"{sheet}.csv").write_bytes(end.join(csv_line(r) for r in rows).encode())


def series(read, rows_of):
    return rows_of(ingest(read).bronze, "tabla", "concepto", "anio", "periodo", "valor")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_csv_sheets(spark, tmp_path, rows_of, end):
    write_csv(tmp_path, BOOK, "Educación ", EDU, end)
    write_csv(tmp_path, BOOK, "Sexo", SEXO, end)
    write_csv(tmp_path, BOOK, "Otra", SEXO, end)
    read = csv_sheets.read_csv_sheets(spark, str(tmp_path), SPECS)
    assert series(read, rows_of) == EXPECTED
    assert ingest(read).quarantine.count() == 0
    assert rows_of(csv_sheets.sheet_catalog(spark, str(tmp_path))) == [
        (BOOK, 1, "Educación "), (BOOK, 2, "Otra"), (BOOK, 3, "Sexo")]


def test_csv_quarantine(spark, tmp_path, rows_of):
    write_csv(tmp_path, BOOK, "Educación ", EDU)
    (tmp_path / BOOK / "Sexo.csv").write_text('t\nt\nt\nk,Ene\n"x,1\n')
    (tmp_path / BOOK / "Corta.csv").write_text("t\nt")
    specs = (*SPECS, SheetSpec(BOOK, "Corta", "corta", "k"), SheetSpec("otro", "Nada", "nada", "k"))
    read = csv_sheets.read_csv_sheets(spark, str(tmp_path), specs)
    assert rows_of(ingest(read).quarantine, "archivo", "hoja", "error") == [
        ("libro+uno.xlsx", "Corta", "no header row below the skipped rows"),
        ("libro+uno.xlsx", "Sexo", "unbalanced quotes"), ("otro", "Nada", "sheet not found")]
    assert {r[0] for r in series(read, rows_of)} == {"edu"}
    report = load_report(ingest(read, store=True), specs)
    assert rows_of(report, "tabla", "filas", "cargada") == [
        ("corta", 0, False), ("edu", 6, True), ("nada", 0, False), ("sexo", 0, False)]


def test_failed_sheets_keep_the_last_good_table(spark, tmp_path, rows_of):
    """A missing sheet and a damaged one leave their tables as they were; the report says so."""
    class Two:
        sheets = staticmethod(lambda: SPECS)

    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir()
    second.mkdir()
    write_csv(first, BOOK, "Educación ", EDU)
    write_csv(first, BOOK, "Sexo", SEXO)
    (second / BOOK).mkdir()
    (second / BOOK / "Sexo.csv").write_text('t\nt\nt\nk,Ene\nMujeres,7\n"x,1\n')
    store = TableStore(spark, "ultima_buena", str(tmp_path / "store"))
    load_bronze(store, csv_sheets.read_csv_sheets(spark, str(first), SPECS), Two)
    before = [rows_of(store.read(f"bronze_{t}")) for t in ("edu", "sexo")]
    report = load_bronze(store, csv_sheets.read_csv_sheets(spark, str(second), SPECS), Two)
    assert [rows_of(store.read(f"bronze_{t}")) for t in ("edu", "sexo")] == before
    assert rows_of(report, "tabla", "filas", "cargada") == [("edu", 0, False), ("sexo", 0, False)]


def test_report_per_sheet(spark, tmp_path, rows_of):
    """Two manifest lines feed one table; only one of their sheets is there."""
    write_csv(tmp_path, BOOK, "Sexo", SEXO)
    specs = (SheetSpec(BOOK, "Sexo", "t", "k", 3), SheetSpec(BOOK, "Falta", "t", "k", 3))
    done = ingest(csv_sheets.read_csv_sheets(spark, str(tmp_path), specs), store=True)
    assert rows_of(load_report(done, specs), "tabla", "filas", "cargada", "error") == [
        ("t", 0, False, "sheet not found"), ("t", 2, True, None)]


def test_large_sheet_is_read_in_splits(spark, tmp_path, rows_of, monkeypatch):
    """Both readers agree on a file cut into many splits, with quoted cells in it."""
    rng = random.Random(7)
    labels = ["Ene", "Feb", "Ene", "Feb", "Total"]
    rows = [["t", ""], ["t"], ["", *labels]]
    for i in range(3000):
        rows.append([f"c{i}, {'x' * rng.randint(0, 60)}", *(str(rng.randint(-99, 99)) for _ in labels)])
    write_csv(tmp_path, BOOK, "Educación ", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        whole = csv_sheets.read_csv_sheets(spark, str(tmp_path), SPECS[:1])
        lines = csv_sheets.read_csv_sheets(spark, str(tmp_path), SPECS[:1], whole_file_bytes=0)
        splits = lines.rows.select(F.col("orden.bloque")).distinct().count()
        got = series(lines, rows_of)
        assert splits > 10 and len(got) == 12000
        assert got == series(whole, rows_of)
        monkeypatch.setattr(csv_sheets, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(csv_sheets, "STRETCH_BYTES", 30000)
        spread = csv_sheets.read_csv_sheets(spark, str(tmp_path), SPECS[:1], whole_file_bytes=0)
        assert series(spread, rows_of) == got
        assert ingest(lines).quarantine.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def both_readers(spark, root, specs, rows_of):
    """Rows and quarantine of the reader of whole files and of the reader of lines."""
    found = []
    for limit in (csv_sheets.WHOLE_FILE_BYTES, 0):
        done = ingest(csv_sheets.read_csv_sheets(spark, str(root), specs, whole_file_bytes=limit))
        found.append((rows_of(done.bronze, "tabla", "concepto", "anio", "periodo", "valor"), rows_of(done.quarantine)))
    return found


def test_line_breaks_in_titles_headers_and_cells(spark, tmp_path, rows_of):
    rows = [["Título\nen dos líneas"], ["t"], ["ramas\ny más", "Ene", "Feb\n", "Ene"], ["a\n\nb", "1", "2", "3"], ["c", "4", "5", "6"]]
    write_csv(tmp_path, BOOK, "Educación ", rows)
    whole, lines = both_readers(spark, tmp_path, SPECS[:1], rows_of)
    assert whole == lines and whole[1] == []
    assert whole[0] == sorted([
        ("edu", "a\n\nb", 2021, "Ene", 1.0), ("edu", "a\n\nb", 2021, "Feb", 2.0), ("edu", "a\n\nb", 2022, "Ene.1", 3.0),
        ("edu", "c", 2021, "Ene", 4.0), ("edu", "c", 2021, "Feb", 5.0), ("edu", "c", 2022, "Ene.1", 6.0)])


@pytest.mark.parametrize("text", [
    "", "\n", "t\nt", "t\nt\n", "t\nt\n\n", "t\nt\nk,Ene", 't\nt\nk,Ene\n"a,1\n', 't\n"t\nk,Ene\na,1\n', "t\rt\rk,Ene\ra,1\r",
    "\ufefft\r\nt\r\nk,Ene\r\n\"a\r\nb\",1", 't\nt\nk,Ene\n"a""\n""b",1\n"",2\n\n"c\n",3'])
def test_both_readers_agree_on_odd_files(spark, tmp_path, rows_of, text):
    (tmp_path / BOOK).mkdir()
    (tmp_path / BOOK / "Educación .csv").write_bytes(text.encode())
    whole, lines = both_readers(spark, tmp_path, SPECS[:1], rows_of)
    assert whole == lines
    if text.startswith("t\nt\nk,Ene\n\"a\"\""):
        assert whole[0] == [("edu", 'a"\n"b', 2021, "Ene", 1.0), ("edu", "c\n", 2021, "Ene", 3.0), ("edu", None, 2021, "Ene", 2.0)]


@pytest.mark.parametrize("seed", range(3))
def test_both_readers_agree_on_files_in_many_splits(spark, tmp_path, rows_of, seed):
    """Cells with line breaks that cross split borders, several kinds of line ends, torn files."""
    rng = random.Random(seed)

    def cell():
        return "".join(rng.choice(['a', 'é', ',', '""', ' ', '\n', '\r\n', 'x' * 40]) for _ in range(rng.randint(0, 12 if rng.random() < 0.9 else 300)))

    specs, end = [], rng.choice(["\n", "\r\n", "\r"])
    (tmp_path / BOOK).mkdir()
    for k in range(4):
        titles = rng.randint(0, 5)
        lines = [f'"{cell()}"' for _ in range(titles)] + [f'"{cell()}",Ene,"Feb",Ene']
        lines += [f'"{cell()}",{rng.randint(0, 99)},"{rng.randint(0, 99)}",{rng.choice(["", "7"])}' if rng.random() < 0.8 else f"c,{i},,"
                  for i in range(rng.randint(20, 150))]
        text = end.join(lines) + (end if rng.random() < 0.5 else "") + ('"' if k == 3 else "")
        (tmp_path / BOOK / f"h{k}.csv").write_bytes(text.encode())
        specs += [SheetSpec(BOOK, f"h{k}", f"t{k}", "c", skip) for skip in {titles, titles if k else 4}]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        whole, lines = both_readers(spark, tmp_path, specs, rows_of)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert whole == lines and len(whole[0]) > 50 and ("t3", BOOK, "h3", "unbalanced quotes") in whole[1]


def test_two_files_of_one_sheet_keep_their_own_headers(spark, tmp_path, rows_of):
    """A partition folder with two large files: each has its own header and its own numbering."""
    folder = tmp_path / "archivo=libro" / "hoja=h"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_text('"t\nt"\nk,Ene\na,1\n')
    (folder / "b.txt").write_text('t\nk,Feb\n"b\nb",2\n')
    specs = [SheetSpec("libro", "h", "t", "c", 1)]
    for limit in (0, 1 << 20):
        read = csv_sheets.read_csv_sheets(spark, str(tmp_path), specs, whole_file_bytes=limit, partitioned=True)
        assert series(read, rows_of) == [("t", "a", 2021, "Ene", 1.0), ("t", "b\nb", 2021, "Feb", 2.0)]


def test_many_quoted_cells(spark):
    """Long quoted texts do not exhaust the regular expression."""
    cell = '"' + 'a""b,\n' * 3000 + '"'
    text = "\n".join([",".join([cell] * 40)] * 3)
    row = spark.createDataFrame([(text,)], "t string").select(
        csv_sheets.split_records(F.col("t")).alias("r")
    ).select(F.size("r").alias("n"), csv_sheets.split_fields(F.col("r")[0]).alias("f")).first()
    assert row.n == 3 and len(row.f) == 40 and row.f[0] == 'a"b,\n' * 3000


def as_cells(rows):
    """Sheet rows as typed cells: numbers as numbers, empty as missing."""
    def cell(text):
        try:
            return None if text == "" else float(text) if text[0].isdigit() else text
        except ValueError:
            return text
    return [[cell(text) for text in row] for row in rows]


BY_SHEET = pytest.mark.parametrize("by_sheet", [True, False])


@BY_SHEET
@pytest.mark.parametrize("inline", [False, True])
def test_xlsx_sheets(spark, tmp_path, rows_of, inline, by_sheet):
    path = tmp_path / BOOK
    write_workbook(path, {"Índice": [["x"]], "Educación ": as_cells(EDU), "Sexo": as_cells(SEXO)}, inline)
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path), SPECS, by_sheet=by_sheet)
    assert series(read, rows_of) == EXPECTED
    assert ingest(read).quarantine.count() == 0
    assert rows_of(xlsx_sheets.sheet_catalog(spark, str(tmp_path), by_sheet)) == [
        (BOOK, 1, "Índice"), (BOOK, 2, "Educación "), (BOOK, 3, "Sexo")]


def test_one_xlsx_sheet_with_two_headers(spark, tmp_path, rows_of):
    write_workbook(tmp_path / BOOK, {"Sexo": [["k", "Ene"], ["a", 1.0], ["k", "Feb"], ["b", 2.0]]})
    specs = (SheetSpec(BOOK, "Sexo", "uno", "k", 0), SheetSpec(BOOK, "Sexo", "dos", "k", 2))
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path), specs)
    assert series(read, rows_of) == [
        ("dos", "b", 2021, "Feb", 2.0), ("uno", "a", 2021, "Ene", 1.0), ("uno", "b", 2021, "Ene", 2.0)]


def test_xlsx_dates_booleans_and_chunks(spark, tmp_path, rows_of):
    rows = [["t"], ["t"], ["k", "Ene", "Feb"], ["d", ("date", 44562), True]]
    rows += [[f"c{i}", i, None] for i in range(4500)]
    write_workbook(tmp_path / BOOK, {"Educación ": rows})
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path), SPECS[:1])
    got = series(read, rows_of)
    assert ("edu", "d", 2021, "Feb", 1.0) in got  # a boolean counts as 1, a date is no number
    assert len(got) == 4501
    places = [r.o for r in read.rows.select(F.col("orden.linea").alias("o")).collect()]
    assert sorted(places) == list(range(3, 4504))


@BY_SHEET
def test_xlsx_quarantine(spark, tmp_path, rows_of, by_sheet):
    (tmp_path / "roto.xlsx").write_bytes(b"not a zip")
    write_workbook(tmp_path / BOOK, {"Sexo": as_cells(SEXO[:2])})
    specs = (*SPECS, SheetSpec("roto.xlsx", "A", "a", "k"))
    specs += (SheetSpec("nunca.xlsx", "B", "b", "k"),)
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path), specs, by_sheet=by_sheet)
    assert rows_of(ingest(read).quarantine, "tabla", "archivo", "hoja", "error") == [
        ("a", "roto.xlsx", "A", "BadZipFile: File is not a zip file"),
        ("b", "nunca.xlsx", "B", "sheet not found"),
        ("edu", BOOK, "Educación ", "sheet not found"),
        ("sexo", BOOK, "Sexo", "no header row below the skipped rows")]
    assert ingest(read).bronze.count() == 0


def test_xlsx_tasks(spark, tmp_path):
    """Two sheets of one book are two tasks, and a task opens its own sheet only."""
    write_workbook(tmp_path / BOOK, {"Sexo": as_cells(SEXO), "Educación ": as_cells(EDU)})
    rows = xlsx_sheets.sheet_rows(spark, str(tmp_path), SPECS)
    places = {r.hoja: r.p for r in rows.select("hoja", F.spark_partition_id().alias("p")).collect()}
    assert rows.rdd.getNumPartitions() == 2 and len(set(places.values())) == 2
    assert xlsx_sheets.sheet_rows(spark, str(tmp_path), ()).collect() == []


def test_paths_that_only_spark_reads(tmp_path):
    assert xlsx_source.reachable(str(tmp_path)) and xlsx_source.reachable(f"file:{tmp_path}") and xlsx_source.reachable(f"file://{tmp_path}")
    assert not xlsx_source.reachable("viewfs://cluster/books") and not xlsx_source.reachable(str(tmp_path / "none"))


def test_written_workbooks_read_back(spark, tmp_path, rows_of):
    rows = [("b 1.xlsx", "h & <1>", [["t"], ["k", "Ene", "Feb"], ["ä <&>", "1.5", ""], [" p\nq ", "-2e3", "x\x01"]]),
            ("b 1.xlsx", "Z", [["k", "Ene"], [None, "7"]]), ("c.xlsx", "Z", [["k"] + ["x"] * 30 + ["Feb"], ["a"] + [""] * 30 + ["3"]])]
    sheets = spark.createDataFrame(rows, "archivo string, hoja string, filas array<array<string>>")
    assert rows_of(write_workbooks(sheets, str(tmp_path / "new"))) == [("b 1.xlsx", 2), ("c.xlsx", 1)]
    specs = [SheetSpec("b 1.xlsx", "h & <1>", "t", "k", 1), SheetSpec("b 1.xlsx", "Z", "z", "k", 0), SheetSpec("c.xlsx", "Z", "c", "k", 0)]
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path / "new"), specs)
    assert series(read, rows_of) == sorted([("t", "ä <&>", 2021, "Ene", 1.5), ("t", " p\nq ", 2021, "Ene", -2000.0),
                                            ("z", None, 2021, "Ene", 7.0), ("c", "a", 2021, "Feb", 3.0)], key=repr)
    assert rows_of(xlsx_sheets.sheet_catalog(spark, str(tmp_path / "new"))) == [("b 1.xlsx", 1, "Z"), ("b 1.xlsx", 2, "h & <1>"), ("c.xlsx", 1, "Z")]


def test_table_store(spark, tmp_path, rows_of):
    store = TableStore(spark, "almacen", str(tmp_path / "db"))
    store.write(spark.range(3), "t")
    store.write(spark.createDataFrame([("a", 1)], "k string, n int"), "t")
    assert rows_of(store.read("t")) == [("a", 1)]
    store.write(spark.createDataFrame([("b", 2)], "k string, n int"), "t", mode="append")
    assert rows_of(store.read("t")) == [("a", 1), ("b", 2)]
    assert rows_of(store.names()) == [("t",)]


def test_a_failed_write_leaves_the_last_version(spark, tmp_path, rows_of):
    """A write that dies half-way, alone or among others, moves no table."""
    store = TableStore(spark, "punteros", str(tmp_path / "db"))
    store.write(spark.createDataFrame([("a", 1)], "k string, n int"), "t")
    store.write(spark.createDataFrame([("u", 1)], "k string, n int"), "u")
    early = store.read("t")
    half = spark.range(100, numPartitions=4).select(
        F.lit("b").alias("k"), F.when(F.col("id") < 60, F.lit(2)).otherwise(F.raise_error(F.lit("lost")).cast("int")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        store.write(half, "t")
    with pytest.raises(Exception, match="lost"):
        store.write_all({"u": spark.createDataFrame([("v", 9)], "k string, n int"), "t": half})
    assert rows_of(store.read("t")) == [("a", 1)] and rows_of(store.read("u")) == [("u", 1)]
    store.write(store.read("t").withColumn("n", F.col("n") + 1), "t")  # from its own rows
    assert rows_of(store.read("t")) == [("a", 2)] and rows_of(early) == [("a", 1)]
    assert store.rows_written("t") == 1
    folders = os.listdir(tmp_path / "db" / "t.versiones")
    assert len(folders) == 2  # the version before stays for its readers, what failed is gone


def test_partitions_are_replaced_by_key(spark, tmp_path, rows_of):
    store = TableStore(spark, "claves", str(tmp_path / "db"))
    for run, value in (("2026-04", 1), ("2026-05", 2), ("2026-04", 3)):
        store.write(spark.createDataFrame([(run, value)], "run_id string, valor int"), "r", ("run_id",), "partitions")
    assert rows_of(store.read("r"), "run_id", "valor") == [("2026-04", 3), ("2026-05", 2)]
    assert store.rows_written("r") is None


def test_report_and_inventory_from_the_write(spark, tmp_path, rows_of):
    """Counts are those the write saw: the report reads no stored row, the inventory no table."""
    write_csv(tmp_path, BOOK, "Educación ", EDU)
    (tmp_path / BOOK / "Sexo.csv").write_text('t\nt\nt\nk,Ene\n"x,1\n')
    specs = (*SPECS, SheetSpec("otro", "Nada", "nada", "k"))
    read = csv_sheets.read_csv_sheets(spark, str(tmp_path), specs)
    columns = ("tabla", "filas", "columnas", "cargada", "error")
    told, counted = ingest(read, store=True, specs=specs), ingest(read, store=True)
    assert rows_of(load_report(told, specs), *columns) == rows_of(load_report(counted, specs), *columns)
    whole = load_report(ingest(csv_sheets.read_csv_sheets(spark, str(tmp_path), SPECS[:1]), store=True, specs=SPECS[:1]), SPECS[:1])
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan and whole.first().filas == 6


def test_stream_replaces_changed_sheets(spark, tmp_path, rows_of):
    root, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def run():
        ingest_new_sheets(spark, root, SPECS, target, state).awaitTermination()
        return rows_of(stored_bronze(spark, target), "tabla", "concepto", "anio", "valor")

    for delivery in ("enero", "febrero"):
        (tmp_path / "in" / delivery).mkdir()
    write_csv(tmp_path / "in" / "enero", BOOK, "Sexo", SEXO)
    first = run()
    assert [r[0] for r in first] == ["sexo", "sexo"]
    write_csv(tmp_path / "in" / "enero", BOOK, "Educación ", EDU)
    second = run()
    assert len(second) == len(EXPECTED)
    changed = [*SEXO[:4], ["Hombres", "7", "8"]]
    write_csv(tmp_path / "in" / "febrero", BOOK, "Sexo", changed)
    third = run()
    assert [r for r in third if r[0] == "sexo"] == [("sexo", "Hombres", 2021, 7.0), ("sexo", "Hombres", 2022, 8.0)]
    assert [r for r in third if r[0] == "edu"] == [r for r in second if r[0] == "edu"]
    assert run() == third

    # All deliveries in one batch: the last version of a sheet counts.
    target, state = str(tmp_path / "out2"), str(tmp_path / "state2")
    old = tmp_path / "in" / "enero" / BOOK / "Sexo.csv"
    os.utime(old, (old.stat().st_mtime - 60,) * 2)
    assert run() == third


SURVEY = Survey("encuesta", "empleo.xlsx", "informalidad.xlsx", "prueba", grammar=PeriodGrammar())


def pad(skip, *rows):
    return [["Nota"]] * skip + [list(r) for r in rows]


def survey_books(tmp_path):
    months, quarters = ["", "Ene", "Feb", "Ene"], ["", "Ene - mar", "Feb - abr", "Ene - mar"]
    write_workbook(tmp_path / "empleo.xlsx", {
        "Total nacional": pad(12, [*months, "Ene*"], [" TGP ", 60.0, 62.0, 64.0, 1.0], ["TD", 10.0, None, 11.004]),
        "Ocupados TN_T13_rama": pad(
            13, months, ["Comercio", 5.0, 6.0, 7.0], ["Industria", 3.0, 3.0, 3.0], ["No informa", 9.0, 9.0, 9.0]),
    })
    write_workbook(tmp_path / "informalidad.xlsx", {
        "Total nacional": pad(12, quarters, ["Concepto", 1.0, 1.0, 1.0], ["Informal", 49.0, 51.0, 47.0]),
        "Ciudades": pad(12, quarters, ["23 ciudades y A.M.", 9e3, 9e3, 9e3], ["Bogotá D.C.", 4020.0, 4022.0, 4021.0],
                        ["Cúcuta", 500.0, 510.0, 520.0], ["Quibdó", 30.0, 31.0, 32.0]),
        "Sexo": pad(12, quarters, ["Mujeres", 50.0, 51.0, 52.0], ["Hombres", 48.0, 49.0, 50.0]),
        "Educación ": pad(12, quarters, ["Básica primaria", 75.0, 75.0, 75.0], ["Básica secundaria^", 70.0, 70.0, 70.0],
                          ["Universitaria", 100.0, 100.0, 100.0], ["Media", 1.0, 1.0, 1.0]),
    })


def test_full_refresh(spark, tmp_path, rows_of):
    survey_books(tmp_path)
    store = TableStore(spark, "encuesta_prueba", str(tmp_path / "db"))
    read = xlsx_sheets.read_xlsx_sheets(spark, str(tmp_path), SURVEY.sheets())
    report = refresh(store, read, SURVEY, "r1")
    assert all(r.cargada and r.error is None for r in report.collect()) and report.count() == 6

    bronze = store.read("bronze_encuesta_total_nacional")
    assert bronze.columns == ["indicador", "anio", "mes", "mes_num", "fecha", "periodo", "valor",
                              "_archivo_origen", "_hoja_origen", "_fecha_carga"]
    assert dict(bronze.dtypes)["fecha"] == "date" and dict(bronze.dtypes)["_fecha_carga"] == "timestamp"
    assert rows_of(store.read("silver_encuesta_total_nacional"), "indicador", "fecha", "periodo", "valor") == [
        ("TD", date(2021, 1, 1), "Ene", 10.0), ("TD", date(2022, 1, 1), "Ene.1", 11.0),
        ("TGP", date(2021, 1, 1), "Ene", 60.0), ("TGP", date(2021, 1, 1), "Ene*", 1.0),
        ("TGP", date(2021, 2, 1), "Feb", 62.0), ("TGP", date(2022, 1, 1), "Ene.1", 64.0)]
    assert rows_of(store.read("gold_metricas_empleo_anual")) == [
        (2021, "TD", 10.0, 10.0, 10.0, None, 1), (2021, "TGP", 41.0, 1.0, 62.0, 34.66, 3),
        (2022, "TD", 11.0, 11.0, 11.0, None, 1), (2022, "TGP", 64.0, 64.0, 64.0, None, 1)]
    assert rows_of(store.read("gold_empleo_top_ramas")) == [
        (2021, "Comercio", 5.5, 11.0, 2), (2021, "Industria", 3.0, 6.0, 2),
        (2022, "Comercio", 7.0, 7.0, 1), (2022, "Industria", 3.0, 3.0, 1)]
    dashboard = store.read("gold_dashboard_informalidad")
    assert dashboard.columns == ["anio", "dimension", "categoria", "tasa_informalidad_promedio"]
    assert (2021, "Total Nacional", "General", 50.0) in rows_of(dashboard)
    assert dashboard.count() == 2 * (1 + 2 + 4)
    final = store.read("gold_recomendaciones_focalizacion")
    assert final.columns[:9] == store.read("gold_perfil_ciudades_ml").columns
    assert rows_of(final, "ciudad", "tasa_informalidad_promedio_miles", "indice_vulnerabilidad_educativa",
                   "instrumento_recomendado", "prioridad") == [
        ("Bogotá D.C.", 4021.0, 0.73, "INTERVENCIÓN MIXTA (Formación + Subsidio)", "ALTA"),
        ("Cúcuta", 510.0, 0.73, "FORMACIÓN TÉCNICA", "MEDIA"),
        ("Quibdó", 31.0, 0.73, "SUBSIDIO A CONTRATACIÓN", "BAJA")]
    assert store.read("run_params").count() == 6 and store.read("run_metrics").count() == 7

    counts = ordered_inventory(inventory(store, SURVEY)).collect()
    assert [r.capa for r in counts] == [LAYERS[0]] * 6 + [LAYERS[1]] * 6 + [LAYERS[2]] * 3 + [LAYERS[3]] * 2
    assert counts[1].tabla == "bronze_encuesta_total_nacional" and counts[1].num_filas == 6

    refresh(store, read, SURVEY, "r2")  # a second run replaces the tables and appends its record
    assert store.read("gold_perfil_ciudades_ml").count() == 3
    assert store.read("run_params").select("run_id").distinct().count() == 2
    refresh(store, read, SURVEY, "r2")  # repeated under its id it replaces its record
    assert store.read("run_params").count() == 12 and store.read("run_metrics").count() == 14
    assert "FileScan" not in inventory(store, SURVEY)._jdf.queryExecution().executedPlan().toString()


def test_table_rows_take_the_concept_name(spark):
    bronze = spark.createDataFrame([("sexo", "M", 1.0), ("edu", "P", 2.0)], "tabla string, concepto string, valor double")
    assert table_rows(bronze, SPECS[1]).columns == ["sexo", "valor"]
