"""Registered queries against their SQL twins on the smallest tables.

Fleets are left to ``test_builds.py`` and ``check_queries.py``.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of
from telemill.queries import catalog

SF = "/root/testdata/sf0.001"
FLEETS = {"fleet_build", "fleet_resume"}
NAMES = [n for n in catalog.QUERIES if n not in FLEETS]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = rows_of(entry.queries()[name](spark, SF).toPandas())
    assert got == rows_of(duck.execute(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
