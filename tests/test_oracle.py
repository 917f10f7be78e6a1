"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check, smaller)."""

from __future__ import annotations

import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from loanlife.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                  "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _duck_type(spark_type: str) -> str:
    t = spark_type.lower()
    return t.upper().replace(" ", "") if t.startswith("decimal") else _SPARK_TO_DUCK.get(t, t.upper())


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def check(con, df, sql):
    """Same columns, types and rows in any order."""
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    otypes = {c: str(t).upper().replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    assert {c: _duck_type(t) for c, t in df.dtypes} == otypes
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    check(con, QUERIES[name](spark, SF), ORACLE[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1500
