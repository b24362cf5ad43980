"""Checks of single messages: on raw JSON text, and of typed rows against the Avro contract."""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.times import parse_event_time

# The range a live temperature must lie in, and the fields a message must have.
MIN_TEMPERATURE = -20.0
MAX_TEMPERATURE = 60.0
REQUIRED_FIELDS = ("truck_id", "temperature", "timestamp")

CONTRACT_PATH = Path(__file__).resolve().parent.parent / "contracts" / "reading.avsc"


def validate_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``is_valid`` and ``reason`` (null when valid) to JSON messages.

    Types are judged on the text, before any cast: an id of ``"1"`` or ``1.0`` is no integer, and ``true`` is
    no number. Text that is no JSON object has no fields.
    """
    document = F.try_parse_json(value)

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant"))

    parsed = messages.withColumns({f"_{name}": kind(name) for name in REQUIRED_FIELDS})
    # An integer too long for 64 bits is typed as a decimal, as is 1.0; only the text tells them apart.
    long_integer = F.col("_truck_id").startswith("DECIMAL(") & F.get_json_object(value, "$.truck_id").rlike(
        r"\A-?\d+\z"
    )
    integer_id = (F.col("_truck_id") == "BIGINT") | long_integer
    number = F.col("_temperature").isin("BIGINT", "DOUBLE", "FLOAT") | F.col("_temperature").startswith(
        "DECIMAL("
    )
    degrees = F.try_variant_get(document, "$.temperature", "double")
    in_range = degrees.between(MIN_TEMPERATURE, MAX_TEMPERATURE)
    clock = parse_event_time(F.try_variant_get(document, "$.timestamp", "string"))

    reason = F.lit(None).cast("string")
    checks = [
        *[(F.col(f"_{name}").isNull(), f"missing {name}") for name in REQUIRED_FIELDS],
        (~integer_id, "truck_id is not an integer"),
        (~number, "temperature is not a number"),
        (F.col("_timestamp") != "STRING", "timestamp is not text"),
        (~F.coalesce(in_range, F.lit(False)), "temperature out of range"),
        (clock.isNull(), "timestamp is not ISO-8601"),
    ]
    for failed, text in reversed(checks):
        reason = F.when(failed, text).otherwise(reason)
    judged = parsed.withColumn("reason", reason)
    return judged.withColumn("is_valid", F.col("reason").isNull()).select(
        *messages.columns, "is_valid", "reason"
    )


def load_contract(path: str | Path = CONTRACT_PATH) -> dict:
    return json.loads(Path(path).read_text())


def _field_holds(field: dict, types: dict[str, str]) -> Column:
    declared = field["type"] if isinstance(field["type"], list) else [field["type"]]
    name, nullable = field["name"], "null" in declared
    if name not in types:
        return F.lit(nullable)
    base = next(t for t in declared if t != "null")
    stored = types[name]
    numeric = stored in ("tinyint", "smallint", "int", "bigint")
    if base in ("int", "long"):
        fits = F.lit(numeric)
        if base == "int" and stored == "bigint":
            fits = F.col(name).between(-(2**31), 2**31 - 1)
    elif base in ("float", "double"):
        fits = F.lit(numeric or stored in ("float", "double") or stored.startswith("decimal"))
    elif base == "string":
        fits = F.lit(stored == "string")
    else:
        raise ValueError(f"no check for contract type {base!r}")
    return F.when(F.col(name).isNull(), F.lit(nullable)).otherwise(fits)


def validate_contract(rows: DataFrame, contract: dict | None = None) -> DataFrame:
    """Add ``in_contract``: every field of the record type present where required and of its type.
    Fields the contract does not know are ignored."""
    fields = (contract or load_contract())["fields"]
    types = dict(rows.dtypes)
    holds = reduce(lambda a, b: a & b, [_field_holds(f, types) for f in fields])
    return rows.withColumn("in_contract", holds)


def split_by_contract(rows: DataFrame, contract: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to send on and rows to set aside."""
    judged = validate_contract(rows, contract)
    valid = judged.where("in_contract").drop("in_contract")
    return valid, judged.where(~F.col("in_contract")).drop("in_contract")
