"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from tabularis.llm.queries import ORACLE, QUERIES
from tabularis.sources.tables import TABLES, table_path
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    found = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in found.collect()]
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert compare(rows, found.columns, want.fetchall(), columns) is None
