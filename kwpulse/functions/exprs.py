"""Column expressions shared by the operators (all JVM built-ins, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the keyword token pattern (Latin-1 letters, digits, apostrophe;
# at least two characters).
TOKEN_PATTERN = "[A-Za-zÀ-ÖØ-öø-ÿ0-9']{2,}"
DIGITS_ONLY = "^[0-9]+$"
EPOCH = "1970-01-01 00:00:00"


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(value)))


def blank_to_null(c: Column) -> Column:
    """Python truthiness for strings: '' counts as absent."""
    return F.when(c == "", F.lit(None)).otherwise(c)


def first_truthy(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def safe_rate(num: Column, plays: Column) -> Column:
    return F.when(plays > 0, num / plays).otherwise(F.lit(0.0))


def epoch_seconds_to_ts(secs: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC without touching the session zone."""
    return F.timestamp_add("SECOND", secs, ts_lit(EPOCH))


def norm_region(region: Column) -> Column:
    """Dashboard normalisation: strip + upper; missing -> UNKNOWN."""
    return F.coalesce(F.upper(F.trim(region)), F.lit("UNKNOWN"))


def growth_case(curr: Column, prev: Column) -> Column:
    """999.0 for a new keyword with >1 mention, 0 for a single new one, else relative growth."""
    return (F.when((prev == 0) & (curr > 1), F.lit(999.0))
            .when(prev == 0, F.lit(0.0))
            .otherwise((curr - prev) / prev))


def r6(c: Column) -> Column:
    """Round floating aggregates so two engines hash alike."""
    return F.round(c, 6)
