"""The corpus queries that SQL can express, against their DuckDB oracles on sf0.01 (whole tables)."""

import duckdb
import pytest
from test_oracle import TABLES, check

from loanlife.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    check(con, QUERIES[name](spark, SF), ORACLE[name])
