"""Queries of the operators against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from fiscora.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    sql = con.sql(oracle_sql()[name])
    assert sorted(sql.columns) == columns
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    want = con.sql(f"select {', '.join(columns)} from ({oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=key) == sorted(want, key=key)
