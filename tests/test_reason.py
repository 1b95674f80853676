"""The written reason spells out numbers of any size."""

from pyspark.sql import functions as F

from periodgrid.functions.text import plain_text
from periodgrid.operators.rules import recommend


def test_reason_has_no_exponent(spark):
    columns = "ciudad string, severidad_informalidad string, indice_vulnerabilidad_educativa double, tasa_informalidad_promedio_miles double"
    rows = [("a", "ALTA", 1.0, 18318321.33), ("b", "BAJA", 250000.25, 399.5), ("c", "MEDIA", None, 500.0)]
    said = {r.ciudad: r.justificacion for r in recommend(spark.createDataFrame(rows, columns)).collect()}
    assert "(18318321.0 mil informales)" in said["a"] and "tiene 0.0% más" in said["a"]
    assert "(400.0 mil informales)" in said["b"] and "educativa: 250000.25." in said["b"]
    assert "tiene 24999925.0% más" in said["b"]
    assert said["c"] is None


def test_plain_text(spark):
    values = [0.0, -0.5, 9999999.0, 1e7, -18318321.0, 12345678.25, 1.2e17, 1e25, float("inf"), None]
    shown = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(plain_text(F.col("v"))).collect()]
    assert shown == ["0.0", "-0.5", "9999999.0", "10000000.0", "-18318321.0", "12345678.25", "120000000000000000.0",
                     "1.0E25", "Infinity", None]
