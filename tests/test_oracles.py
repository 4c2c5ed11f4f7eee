"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from catalogue.jobs import JOBS
from catalogue.oracles import ORACLES

SF_DIR = os.environ.get("TARN_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return str(value) if hasattr(value, "isoformat") else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(table, key=lambda row: tuple((v is None, str(v)) for v in row))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(JOBS))
def test_query(spark, duck, name):
    result = JOBS[name](spark, SF_DIR)
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    answer = duck.execute(ORACLES[name])
    duck_types = {d[0]: str(d[1]) for d in answer.description}
    expected = _rows([d[0] for d in answer.description], answer.fetchall())
    actual = _rows(result.columns, [tuple(r) for r in rows])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1]) > 0
    different = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    assert not different, different[:5]
    spark_types = {n: SPARK_TO_DUCK.get(t, t) for n, t in result.dtypes}
    assert spark_types == duck_types
