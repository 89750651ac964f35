"""Every registered query with a twin gives the same rows as the twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract

SLOW = {"kmeans_sweep", "clustering_summary", "classify_compare", "classify_side_by_side"}


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    return con


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_twin(spark, sf, duck, name):
    df = contract.queries()[name](spark, sf)
    got = df.collect()
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expect = cursor.fetchall()
    at = [columns.index(c) for c in df.columns]
    assert sorted((tuple(r) for r in got), key=repr) == sorted((tuple(r[i] for i in at) for r in expect), key=repr)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - SLOW))
def test_query_without_twin_has_rows(spark, sf, name):
    assert contract.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
