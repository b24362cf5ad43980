"""Physical plans: what is exchanged, and that one truck cannot fill one task."""

import re

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.alerts import sustained_alerts
from fleetgauge.operators.recovery import recovery_audit
from fleetgauge.operators.dedup import accepted_readings
from fleetgauge.operators.fleet import fleet_latest
from fleetgauge.operators.rates import counter_rate
from fleetgauge.operators.state import running_state
from fleetgauge.operators.windows import window_averages
from fleetgauge.plans import fleet_tables

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchange_keys(plan):
    """Keys of the exchanges that move rows, not counting reused ones."""
    lines = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", "\n".join(lines))


def test_windows_take_three_exchanges_for_both_kinds(spark):
    plan = executed(window_averages(fleet_tables.normalized_readings(spark, SF_DIR)))
    keys = exchange_keys(plan)
    assert len(keys) == 3, plan
    assert "timestamp" in keys[-1] and "window" in keys[0]
    assert plan.count("FileScan") == 1


def test_scan_reads_only_what_is_used(spark):
    plan = executed(window_averages(fleet_tables.normalized_readings(spark, SF_DIR)))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert set(re.findall(r"(\w+):", schema)) == {"event_id", "ts", "user_id", "value"}


def test_text_is_parsed_once(spark):
    """No filter on the parsed time may be pushed below the aggregate that removes duplicates."""
    plan = executed(window_averages(fleet_tables.normalized_readings(spark, SF_DIR)))
    assert plan.count("try_cast(") <= 2, plan


def test_hot_truck_is_cut_into_blocks(spark):
    plan = executed(running_state(fleet_tables.normalized_readings(spark, SF_DIR)))
    windows = re.findall(r"windowspecdefinition\(([^,]*(?:, [^,]*)*?) ASC", plan)
    assert any("_block" in w for w in windows)
    # Readings are exchanged by block; only one row per block is exchanged by truck alone.
    assert "ReusedExchange" in plan
    alone = [k for k in exchange_keys(plan) if k.count("#") == 1]
    assert len(alone) == 1


def test_latest_values_sort_no_readings_and_remove_duplicates_once(spark):
    plan = executed(fleet_latest(accepted_readings(fleet_tables.raw_readings(spark, SF_DIR))))
    assert "SortAggregate" not in plan
    assert sum("timestamp" in k for k in exchange_keys(plan)) == 1, plan


@pytest.mark.parametrize("name", ["counter", "alerts"])
def test_series_are_cut_into_spans(spark, name):
    if name == "counter":
        df = counter_rate(fleet_tables.counter_samples(spark, SF_DIR))
    else:
        df = sustained_alerts(fleet_tables.gauge_samples(spark, SF_DIR))
    plan = executed(df)
    assert "ReusedExchange" in plan
    assert any("_span" in k for k in exchange_keys(plan))


def test_no_plan_joins_without_a_key(spark, tmp_path):
    for df in (
        recovery_audit(fleet_tables.normalized_readings(spark, SF_DIR), f"{tmp_path}/recovery"),
        running_state(fleet_tables.normalized_readings(spark, SF_DIR)).agg(F.count("*")),
    ):
        plan = executed(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
