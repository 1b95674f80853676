"""Every registered query against its SQL, on the same files."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from periodgrid.plans.catalog import QUERIES, SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    relation = duck.sql(oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    places = [relation.columns.index(c) for c in columns]
    assert got == sorted((tuple(row[p] for p in places) for row in relation.fetchall()), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries())
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["anio", "indicador", "promedio_anual", "valor_minimo", "valor_maximo",
                          "desviacion_estandar", "num_observaciones"]
    assert df.count() == 35
