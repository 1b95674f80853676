"""The wide sheet of many concepts: one row each, and no wide row held for every cell."""

from pyspark.sql import functions as F

from periodgrid.operators.reshape import spread
from periodgrid.plans.catalog.series import MONTH_LABELS, orders_sheet, wide_sheet

LABELS = ["a", "b", "c"]


def test_spread(spark):
    rows = [("x", "c", "3"), ("x", "a", "1"), ("y", "b", None), ("z", None, "9"), ("w", "other", "8"), (None, "b", "2")]
    wide = spread(spark.createDataFrame(rows, "k string, p string, v string"), "k", "p", "v", LABELS)
    assert wide.columns == ["k", *LABELS]
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(
        [("x", "1", None, "3"), ("y", None, None, None), ("z", None, None, None), ("w", None, None, None), (None, None, "2", None)], key=repr)


def test_spread_equals_pivot(spark):
    cells = spark.range(5000).select((F.col("id") % 700).alias("k"), F.element_at(F.array(*map(F.lit, LABELS)), (F.col("id") % 3 + 1).cast("int")).alias("p"), "id")
    sums = cells.groupBy("k", "p").agg(F.sum("id").alias("v"))
    assert sorted(spread(sums, "k", "p", "v", LABELS).collect()) == sorted(cells.groupBy("k").pivot("p", LABELS).sum("id").collect())


def test_sheet_of_customers_keeps_no_wide_row_per_cell(spark, sf_dir):
    sheet = orders_sheet(spark, sf_dir, "o_custkey")
    assert sheet.columns == ["concepto", *MONTH_LABELS]
    assert "pivotfirst" not in sheet._jdf.queryExecution().executedPlan().toString()


def test_headed_sheet_of_customers_keeps_no_wide_row_per_cell(spark, sf_dir):
    from periodgrid.plans.catalog.series import grid_header_suffix

    plan = grid_header_suffix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "pivotfirst" not in plan


def test_sheets_of_customers_sum_no_cells_before_the_shuffle(spark, sf_dir):
    from periodgrid.plans.catalog.series import grid_header_suffix, long_from_wide_entities

    for query in (grid_header_suffix, long_from_wide_entities):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        deal = plan[plan.rindex("Exchange hashpartitioning("):]
        assert "FileScan" in deal and "Aggregate" not in deal


def test_dealt_sheet_equals_summed_sheet(spark):
    rows = spark.range(3000).selectExpr(
        "if(id % 7 = 0, NULL, id % 211) AS k", "id / 100.0 AS v",
        "if(id % 5 = 0, NULL, date_add(DATE'1995-01-01', CAST(id * 13 % 2500 AS INT))) AS d")
    sheets = [wide_sheet(rows, "k", "d", "v", many) for many in (False, True)]
    summed, dealt = (sorted(map(tuple, sheet.collect()), key=repr) for sheet in sheets)
    assert len(dealt) == 212 and dealt == summed
