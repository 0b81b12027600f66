import duckdb
import pytest

from lograft.llm import queries
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, res.fetchall())) == sorted(map(repr, map(tuple, df.select(*cols).collect())))
