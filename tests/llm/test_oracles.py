"""The queries that SQL can express against their DuckDB SQL, on the small test tables."""

import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="test tables not present")
def test_queries_match_their_sql(spark):
    from sevlab.llm.registry import ORACLES, QUERIES
    from sevlab.session import ship_package

    ship_package(spark)
    assert set(ORACLES) <= set(QUERIES)
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SF)
        found = con.execute(sql)
        columns = sorted(df.columns)
        assert columns == sorted(d[0] for d in found.description), name
        at = {d[0]: i for i, d in enumerate(found.description)}
        want = sorted(repr([r[at[c]] for c in columns]) for r in found.fetchall())
        assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == want, name
