"""Every registered query against its SQL, on the smallest tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
import verify
from wattline.operators import skew, validate
from wattline.sources.tables import POSITION
from wattline.workload.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_spark_and_sql_agree(spark, con, name):
    assert verify.check(spark, con, SF, name) == []


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["rule_flags_billing", "rule_flags_readings", "fact_readings", "fact_billing", "reference_check"]
)
def test_queries_agree_when_lookups_are_long_and_keys_hot(spark, con, monkeypatch, name):
    """The same queries with every lookup taken as too long to broadcast and small groups as hot."""
    broadcast_rows, hot_rows = 0, 5
    monkeypatch.setattr(skew.lookup_join, "__defaults__", (broadcast_rows, hot_rows, None))
    monkeypatch.setattr(skew.flag_unknown_keys, "__defaults__", (broadcast_rows, hot_rows))
    monkeypatch.setattr(validate.flag_rows, "__defaults__", (None, POSITION, broadcast_rows, hot_rows))
    assert verify.check(spark, con, SF, name) == []
