"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from acceptance import CASES
from acceptance.check import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(CASES))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


def test_contract(spark):
    assert contract.entry(spark).columns[:2] == ["city", "year"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert all(name in contract.oracle_sql() for name in CASES)


def test_session_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        assert difference(spark, oracle_connection(SF_DIR), "gold_potencial_solar", SF_DIR) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
