"""ISO-8601 text to instants and back. The session time zone must be UTC (``session.pin_utc``)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the usual form goes straight to the cast, the rarer ones are completed first.
_DATE = r"\d{4}-\d{2}-\d{2}"
_OFFSET = r"(Z|[+-]\d{2}(?::?\d{2})?)?"
_FULL = rf"\A{_DATE}[T ]\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d+)?{_OFFSET}\z"
_RARE = rf"\A{_DATE}(?:[T ]\d{{2}}(?::\d{{2}}(?::\d{{2}}(?:[.,]\d+)?)?)?{_OFFSET})?\z"
_HOUR_ONLY = rf"\A({_DATE}[T ]\d{{2}}){_OFFSET}\z"
_MINUTE_ONLY = rf"\A({_DATE}[T ]\d{{2}}:\d{{2}}){_OFFSET}\z"


def instant(moment: datetime) -> Column:
    """A moment as a column; without a zone it is UTC, wherever the driver runs."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).cast("timestamp")


def parse_event_time(text: Column | str) -> Column:
    """Instant of an ISO-8601 text; without an offset it is UTC; null when it is not a timestamp.

    A bare cast would also take forms such as ``2026`` or ``2026-7-8``, hence the patterns.
    """
    text = F.col(text) if isinstance(text, str) else text
    completed = F.regexp_replace(text, _HOUR_ONLY, "$1:00:00$2")
    completed = F.regexp_replace(completed, _MINUTE_ONLY, "$1:00$2")
    completed = F.translate(completed, ",", ".")
    return (
        F.when(text.rlike(_FULL), text.try_cast("timestamp"))
        .when(text.rlike(_RARE), completed.try_cast("timestamp"))
    )


def iso_utc(instant: Column | str) -> Column:
    """``2026-07-18T08:50:00+00:00``, with six decimals only when there is a fraction of a second."""
    instant = F.col(instant) if isinstance(instant, str) else instant
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(instant) % 1_000_000 == 0, whole).otherwise(exact)
