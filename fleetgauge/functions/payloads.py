"""State keys and JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE_KEY_PREFIX = "truck:"


def state_key(truck_id: Column | str) -> Column:
    truck_id = F.col(truck_id) if isinstance(truck_id, str) else truck_id
    return F.concat(F.lit(STATE_KEY_PREFIX), truck_id.cast("string"))


def truck_of_key(key: Column | str) -> Column:
    """The id behind the first colon."""
    key = F.col(key) if isinstance(key, str) else key
    return F.split(key, ":", 2)[1].try_cast("bigint")


def encode(*columns: str) -> Column:
    """JSON object of the named columns; nulls are written as such, so a reader sees every field."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode(value: Column | str, schema: T.StructType) -> Column:
    """Struct read with the reader's own schema: unknown fields are ignored and missing ones are null.
    Text that is no JSON object gives null in every field."""
    return F.from_json(value, schema)
