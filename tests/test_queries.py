"""Every query of the order domain against its SQL, on the smallest given tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver
from tools.compare import difference
from weir.operators.lookup import Lookup
from weir.plans.catalog import all_queries
from weir.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(ORACLE)
    assert set(ORACLE) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sql, name):
    ours = driver.queries()[name](spark, SF).toPandas()
    assert difference(ours, sql.execute(driver.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize(
    "name", ["validate_sale", "enrich_coffee", "membership_semi", "membership_anti", "lookup_miss_report", "stream_enrich"]
)
def test_query_matches_sql_when_no_lookup_may_be_broadcast(spark, sql, name, monkeypatch):
    monkeypatch.setattr(Lookup, "is_small", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = driver.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert difference(ours, sql.execute(driver.oracle_sql()[name]).df()) == ""


def test_entry_returns_rows(spark):
    assert driver.entry(spark).columns == ["store_id", "order_count", "revenue"]
