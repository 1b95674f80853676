"""Clustered and bucketed tables, many rules, merged sketches."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from periodgrid.operators import joins, rule_index
from periodgrid.operators.rule_index import first_match_by_intervals, rule_intervals
from periodgrid.operators.rules import Rule, first_match, rule_table
from periodgrid.operators.sketches import distinct_sketches, estimated, united
from periodgrid.sources.tables import TableStore

INDEX, SEVERITY, LABEL = "indice_vulnerabilidad_educativa", "severidad_informalidad", "instrumento_recomendado"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_skip_files_of_a_clustered_table(spark, tmp_path):
    store = TableStore(spark, "agrupada", str(tmp_path / "db"))
    rows = spark.range(80_000, numPartitions=8).select((F.col("id") % 8 + 2015).cast("int").alias("anio"), F.rand(3).alias("valor"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write(rows, "t", order_by=("anio", "valor"))
        store.write(rows, "suelta")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)

    def scanned(name):
        found = store.read(name).where("anio = 2016")
        found.collect()
        metrics, stack = [], [found._jdf.queryExecution().executedPlan()]
        while stack:
            node = stack.pop()
            if node.nodeName().startswith("Scan parquet"):
                metrics.append(node.metrics().get("numOutputRows").get().value())
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
        return sum(metrics), found.count()

    assert scanned("suelta") == (80_000, 10_000)
    read, kept = scanned("t")
    assert kept == 10_000 and read <= 30_000


def test_bucketed_tables_are_joined_in_place(spark, tmp_path, rows_of):
    store = TableStore(spark, "cubos", str(tmp_path / "db"))
    left = spark.range(500).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("ciudad"), F.col("id").alias("v"))
    right = left.groupBy("ciudad").agg(F.max("v").alias("w"))
    for _ in range(2):  # replaced like any other table
        store.write_bucketed(left, "hechos", ("ciudad",), 4)
    store.write_bucketed(right, "perfil", ("ciudad",), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = store.read("hechos").join(store.read("perfil"), "ciudad").groupBy("ciudad").agg(F.sum("v").alias("s"), F.max("w").alias("w"))
        assert "Exchange" not in plan(joined)
        want = left.join(right, "ciudad").groupBy("ciudad").agg(F.sum("v").alias("s"), F.max("w").alias("w"))
        assert rows_of(joined) == rows_of(want) and store.rows_written("hechos") == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows_of(store.names()) == [("hechos",), ("perfil",)]
    store.write(left, "hechos")
    assert store.read("hechos").count() == 500 and "Num Buckets" not in store._described("hechos")


def cases(spark, n=400):
    rng = random.Random(2)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 0.5]
    rows = [(i, rng.choice(["ALTA", "MEDIA", "BAJA", "NADA", None]), rng.choice(odd) if rng.random() < 0.2 else round(rng.uniform(-1, 2), 2)) for i in range(n)]
    return spark.createDataFrame(rows, f"id int, {SEVERITY} string, {INDEX} double")


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_intervals_equal_the_chain(spark, rows_of, monkeypatch, limit):
    monkeypatch.setattr(rule_index, "BROADCAST_BYTES", limit)
    rng = random.Random(9)
    bounds = [None, 0.5, 0.0] + [round(rng.uniform(-1.5, 2.5), 2) for _ in range(40)]
    rules = [Rule(rng.choice(["ALTA", "MEDIA", "BAJA"]), f"r{i}", rng.choice(bounds)) for i in range(60)]
    rules = sorted(rules, key=lambda rule: rule.min_index is None)  # rules without a bound last
    rows = cases(spark)
    for some in (rules, rules[:3], [Rule("ALTA", "uno", 0.5)], [Rule("BAJA", "todos")]):
        chain = rows.withColumn(LABEL, first_match(F.col(SEVERITY), F.col(INDEX), some))
        assert repr(rows_of(first_match_by_intervals(rows, rule_table(spark, some)))) == repr(rows_of(chain))


def test_a_hundred_thousand_rules(spark):
    """Against bisection in plain Python; a row meets a handful of intervals."""
    rng = random.Random(1)
    rules = [(i, rng.choice(["ALTA", "MEDIA"]), rng.uniform(0, 1) ** 3, f"r{i}") for i in rng.sample(range(10 ** 6), 100_000)]
    table = spark.createDataFrame(rules, "regla int, severidad string, minimo double, etiqueta string")
    best = {}
    for severity in ("ALTA", "MEDIA"):
        lows, labels, least = [], [], None
        for low, rule in sorted((r[2], r[0]) for r in rules if r[1] == severity):
            least = rule if least is None else min(least, rule)
            lows.append(low)
            labels.append(least)
        best[severity] = lows, labels
    got = first_match_by_intervals(cases(spark, 3000), table).collect()
    for row in got:
        lows, labels = best.get(row[SEVERITY], ([], []))
        x = row[INDEX]
        at = len(lows) if x is not None and x != x else bisect.bisect_right(lows, x) if x is not None else 0
        assert row[LABEL] == (f"r{labels[at - 1]}" if at else "MONITOREO")
    assert rule_intervals(table).count() < 100  # only changes of the first match are kept


def test_sketches_unite(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("hoja"), (F.col("id") % 20_011).alias("v"))
    rows = rows.unionByName(spark.range(5).select((F.col("id") % 3).alias("hoja"), F.lit(None).cast("long").alias("v")))
    per_sheet = distinct_sketches(rows, ("hoja",), "v")
    whole = estimated(united(per_sheet)).first().distintos
    assert abs(whole - 20_011) <= 400
    small = distinct_sketches(rows, ("hoja",), "v", lg_k=10)
    assert abs(estimated(united(per_sheet.unionByName(small))).first().distintos - 20_011) <= 2_000
    assert estimated(distinct_sketches(rows.where("v IS NULL"), ("hoja",), "v")).first().distintos == 0
