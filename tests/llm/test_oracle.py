import duckdb
import pytest

from inkwell.llm import queries

from .helpers import SMALL

# The scale at which a query's result is not empty (phrases need 100 occurrences).
SCALE = {"op12_collocations": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_with_sql_equal_their_oracle(spark, name):
    folder = SCALE.get(name, SMALL)
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df, want = queries.queries()[name](spark, folder), con.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted(tuple(r[c] for c in want.columns) for r in df.collect())
    assert got == sorted(want.fetchall()) and got
