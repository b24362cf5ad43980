"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fleetgauge.plans.oracles import ORACLES
from fleetgauge.plans.registry import REGISTRY
from check_oracles import TABLES, compare
from fleetgauge.plans import fleet_tables
from fleetgauge.plans.snapshot import fleet_snapshot
from fleetgauge.operators.windows import window_averages

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, con, name):
    text, fine = compare(spark, con, name, REGISTRY[name], ORACLES[name], SF_DIR)
    assert fine, text


def test_every_query_has_sql():
    """The text queries have tests of their own, and those that SQL cannot express have none."""
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_snapshot_parts(spark):
    readings = fleet_tables.raw_readings(spark, SF_DIR)
    averages = fleet_tables.closed_windows(window_averages(fleet_tables.normalized_readings(spark, SF_DIR)))
    parts = fleet_snapshot(readings, averages)
    assert set(parts) == {"totals", "rates", "throughput", "recent_readings", "trucks", "anomalies"}
    assert parts["totals"].count() == 1
    assert parts["recent_readings"].count() == 20
    assert parts["throughput"].count() == 60
    assert {"gps_source", "is_anomalous", "tumbling_avg"} <= set(parts["trucks"].columns)
