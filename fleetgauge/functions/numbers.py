"""Temperature arithmetic.

Temperatures are rounded to two decimals before they are summed, so sums are whole hundredths: exact, and independent
of the order in which partitions are merged. The hundredths of one reading are a bigint and their sum is a decimal,
which ten thousand million of the largest readings do not overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hundredths of so many degrees no longer fit a bigint. ``normalize.rejected_readings`` names such readings.
TEMPERATURE_LIMIT = 9.2e16
# A sum of hundredths up to here stays a bigint when its average is scaled to ten thousandths.
BIGINT_SUM = 90_000_000_000_000_000


def passes_temperature_filter(temperature: Column | str) -> Column:
    """Above zero. Spark orders NaN above every number, so it is excluded by name; null is not above zero."""
    t = F.col(temperature) if isinstance(temperature, str) else temperature
    return F.coalesce((t > 0) & ~F.isnan(t), F.lit(False))


def to_centi(temperature: Column | str) -> Column:
    """Hundredths of a degree, half away from zero."""
    t = F.col(temperature) if isinstance(temperature, str) else temperature
    return F.when(t < 0, -F.floor(-t * 100 + 0.5)).otherwise(F.floor(t * 100 + 0.5))


def from_centi(centi: Column | str) -> Column:
    c = F.col(centi) if isinstance(centi, str) else centi
    return c / F.lit(100.0)


def sum_of_centi(centi: Column | str) -> Column:
    """Exact sum of hundredths."""
    c = F.col(centi) if isinstance(centi, str) else centi
    return F.sum(c.cast("decimal(19,0)"))


def centi_of_sum(total: Column | str) -> Column:
    """Hundredths of a sum in degrees, which may be larger than any reading; null beyond 36 digits."""
    s = F.col(total) if isinstance(total, str) else total
    return (s.try_cast("decimal(36,2)") * 100).cast("decimal(38,0)")


def average_of(centi_sum: Column | str, count: Column | str) -> Column:
    """``sum / count`` in degrees to four decimals, half away from zero; 0.0 when nothing was counted.

    Quotient and remainder are scaled apart, so that the sum itself is never multiplied. Sums up to ``BIGINT_SUM`` are
    divided as bigints, which takes a fraction of the time of decimals.
    """
    s = F.col(centi_sum) if isinstance(centi_sum, str) else centi_sum
    n = F.nullif(F.col(count) if isinstance(count, str) else count, F.lit(0).cast("bigint"))

    def signed(total: Column, wide: str) -> Column:
        magnitude = F.abs(total)
        whole = F.call_function("div", magnitude, n)
        rest = magnitude % n
        ten_thousandths = whole.cast(wide) * 100 + F.call_function("div", rest * 200 + n, n * 2)
        return F.signum(total) * ten_thousandths / 10000.0

    small = s.between(-BIGINT_SUM, BIGINT_SUM)
    mean = F.when(small, signed(s.cast("bigint"), "bigint")).otherwise(signed(s, "decimal(38,0)"))
    return F.coalesce(mean, F.lit(0.0))


def floor_div(number: Column, divisor: int) -> Column:
    """Whole quotient rounded down, in integer arithmetic."""
    by = F.lit(divisor).cast("bigint")
    return F.call_function("div", number - F.pmod(number, by), by)
