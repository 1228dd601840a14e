"""Timestamp parsing and the year shift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybatch.schema import NULL_TOKENS, TARGET_YEAR

SHIFT_POLICIES = ("clamp", "null", "error")


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def normalize_nulls(c) -> Column:
    """Text the pandas CSV reader treats as missing becomes null."""
    c = _col(c)
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def parse_timestamp(c) -> Column:
    """Text to ``timestamp_ntz``; bad text gives null."""
    return _col(c).try_cast("timestamp_ntz")


def shift_year(ts, policy: str = "clamp", year: int = TARGET_YEAR) -> Column:
    """Move a timestamp to ``year``, null kept.

    29 February: ``clamp`` gives 28 February, ``null`` gives null and
    ``error`` fails the query, like a date library that refuses the day.
    """
    ts = _col(ts)
    if policy == "clamp":
        return ts + F.make_ym_interval(F.lit(year) - F.year(ts), F.lit(0))
    secs = F.extract(F.lit("SECOND"), ts)  # decimal(8,6), fraction kept
    args = [F.lit(year), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), secs]
    shifted = F.try_make_timestamp_ntz(*args)
    if policy == "null":
        return shifted
    if policy == "error":
        return F.when(
            ts.isNotNull() & shifted.isNull(),
            F.raise_error(F.concat(F.lit("day is out of range for month: "), ts.cast("string"))),
        ).otherwise(shifted)
    raise ValueError(f"policy must be one of {SHIFT_POLICIES}, got {policy!r}")
