import json

import pytest

from fleetgauge.operators.validation import (
    load_contract,
    split_by_contract,
    validate_contract,
    validate_messages,
)

CLOCK = "2026-07-18T08:50:45.987061+00:00"


def message(**changes):
    fields = {"truck_id": 1, "temperature": 35.5, "timestamp": CLOCK, **changes}
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


CASES = [
    (message(), None),
    (message(temperature=35), None),
    (message(temperature=-20), None),
    (message(temperature=60.0), None),
    (message(truck_id=123456789012345678901234), None),
    (message(fuel_level=1.0, note="x"), None),
    (message(timestamp="2026-07-18"), None),
    ('{"truck_id": 1, "temperature": 3.5e1, "timestamp": "2026-07-18"}', None),
    (message(truck_id=...), "missing truck_id"),
    (message(temperature=...), "missing temperature"),
    (message(timestamp=...), "missing timestamp"),
    (message(temperature="hot"), "temperature is not a number"),
    (message(temperature=None), "temperature is not a number"),
    (message(temperature=True), "temperature is not a number"),
    (message(truck_id="one"), "truck_id is not an integer"),
    (message(truck_id=1.0), "truck_id is not an integer"),
    (message(truck_id=None), "truck_id is not an integer"),
    (message(timestamp=1784364645), "timestamp is not text"),
    (message(timestamp="18/07/2026"), "timestamp is not ISO-8601"),
    (message(temperature=100.0), "temperature out of range"),
    (message(temperature=60.01), "temperature out of range"),
    ("[1, 2]", "missing truck_id"),
    ("{truncated", "missing truck_id"),
    (None, "missing truck_id"),
]


def test_messages(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, value string")
    found = validate_messages(df).orderBy("i").collect()
    assert [(r.value, r.reason) for r in found] == CASES
    assert [r.is_valid for r in found] == [reason is None for _, reason in CASES]


CONTRACT_ROWS = [
    ((1, 30.0, "t", None, None, None), True),
    ((1, 30.0, "t", 1.0, 2.0, 3.0), True),
    ((None, 30.0, "t", None, None, None), False),
    ((1, None, "t", None, None, None), False),
    ((1, 30.0, None, None, None, None), False),
    ((2**31, 30.0, "t", None, None, None), False),
]


def test_contract(readings):
    judged = validate_contract(readings(*[r for r, _ in CONTRACT_ROWS])).orderBy("seq")
    assert [r.in_contract for r in judged.collect()] == [ok for _, ok in CONTRACT_ROWS]


def test_contract_splits_into_valid_and_set_aside(readings):
    df = readings(*[r for r, _ in CONTRACT_ROWS])
    valid, aside = split_by_contract(df)
    assert (valid.count(), aside.count()) == (2, 4)
    assert valid.columns == df.columns


def test_contract_looks_at_types_and_missing_columns(spark):
    assert not validate_contract(spark.sql("SELECT 1L AS truck_id, 'hot' AS temperature, 't' AS timestamp")).first()[-1]
    assert validate_contract(spark.sql("SELECT 1 AS truck_id, 3 AS temperature, 't' AS timestamp")).first()[-1]
    assert not validate_contract(spark.sql("SELECT 1 AS truck_id, 't' AS timestamp")).first()[-1]


def test_unknown_contract_type_is_refused(readings):
    contract = load_contract()
    contract["fields"][0]["type"] = "bytes"
    with pytest.raises(ValueError):
        validate_contract(readings((1, 1.0, "t")), contract)
