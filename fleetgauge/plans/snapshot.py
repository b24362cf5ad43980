"""The dashboard's snapshot as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetgauge.operators.dedup import accepted_readings
from fleetgauge.operators.fleet import (
    fleet_positions,
    fleet_roster,
    recent_anomalies,
    recent_readings,
    roster_page,
)
from fleetgauge.operators.quality import telemetry_totals
from fleetgauge.operators.rates import parsed_rate, stage_rates, throughput_history


def fleet_snapshot(readings: DataFrame, averages: DataFrame) -> dict[str, DataFrame]:
    """Totals, rates and reports over raw readings (``seq``, ``arrival``) and averages (``seq``)."""
    accepted = accepted_readings(readings)
    rates = parsed_rate(stage_rates(readings, averages))
    return {
        "totals": telemetry_totals(readings, averages),
        "rates": rates,
        "throughput": throughput_history(rates),
        "recent_readings": recent_readings(accepted),
        "trucks": fleet_positions(roster_page(fleet_roster(accepted, averages))),
        "anomalies": recent_anomalies(accepted),
    }
