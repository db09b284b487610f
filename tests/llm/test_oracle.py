"""The registered queries against their SQL."""

import duckdb
import pytest

from sampleledger.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_equal_to_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    found = queries.queries()[key](spark, SF_DIR)
    cur = con.execute(queries.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(found.columns)
    plain = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=str)
    assert plain(map(tuple, found.select(names).collect())) == plain(cur.fetchall())
