from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetgauge.schemas import TELEMETRY  # noqa: E402
from fleetgauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readings(spark):
    """Readings from ``(truck_id, temperature, timestamp[, fuel, latitude, longitude])`` in arrival order."""

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY.fields)

    def make(*rows):
        full = [(*row, *[None] * (6 - len(row)), i) for i, row in enumerate(rows)]
        return spark.createDataFrame(full, f"{schema}, seq bigint")

    return make


def rows_of(df, *columns, order=None):
    picked = df.select(*columns) if columns else df
    if order:
        picked = picked.orderBy(*([order] if isinstance(order, str) else order))
    return [tuple(r) for r in picked.collect()]


@pytest.fixture(scope="session")
def rows():
    return rows_of
