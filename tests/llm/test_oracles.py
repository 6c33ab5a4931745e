"""Corpus queries that SQL can express give DuckDB's rows."""

import duckdb
import pytest

pytest.importorskip("curastra.llm")
from curastra.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(ORACLES[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in result.fetchall())
