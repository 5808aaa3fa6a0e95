"""Every query of the catalogue against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from fiscora.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(found) -> list[tuple]:
    clean = [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in found]
    return sorted(clean, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    sql = db.sql(ORACLES[name])
    assert sorted(sql.columns) == columns
    expected = db.sql("select " + ", ".join(f'"{c}"' for c in columns) + f" from ({ORACLES[name]})").fetchall()
    assert rows(df.select(*[f"`{c}`" for c in columns]).collect()) == rows(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_scan_reads_only_its_columns(spark, sf_dir):
    plan = QUERIES["year_totals"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def test_entry_counts(spark, sf_dir):
    import __spark_entry__

    assert {r["status"] for r in __spark_entry__.entry(spark).collect()} <= {"MATCH", "DISCREPANCY", "MISSING_LEFT", "MISSING_RIGHT"}
