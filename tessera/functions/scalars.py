"""Scalar column functions (J1-J28) beyond one-to-one built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.sources.files import DECIMAL_RE, parse_number


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_number(c) -> Column:
    """Text -> double, null unless plain decimal syntax (no NaN/inf, no '1_0')."""
    return parse_number(col_(c))


def marker_to_null(c, markers) -> Column:
    """Listed marker strings (and unparsable text) become null."""
    c = col_(c)
    return F.when(~c.isin(*markers), c)


def strip_chars(c, chars: str) -> Column:
    """Remove every listed character."""
    return F.translate(col_(c), chars, "")


def minutes_between(start, end) -> Column:
    """Whole-second difference in minutes (sub-second part dropped)."""
    return (F.unix_timestamp(col_(end)) - F.unix_timestamp(col_(start))) / 60.0


def hour_start(ts) -> Column:
    """Timestamp truncated to the hour, as a zone-free (NTZ) wall-clock
    value. ``date_trunc`` on an NTZ input returns a session-zone timestamp;
    casting back keeps results independent of the session time zone."""
    return F.date_trunc("hour", col_(ts)).cast("timestamp_ntz")


def day_night(ts, night_start: int = 22, night_end: int = 6) -> Column:
    """J26: 'night' for hours in [night_start, 24) u [0, night_end), else 'day'."""
    h = F.hour(col_(ts))
    return F.when((h >= night_start) | (h < night_end), F.lit("night")).otherwise(F.lit("day"))


def bands(c, bounds, default=None) -> Column:
    """CASE over ascending upper bounds [(upper, label), ...]; first match wins.
    ``default=None`` means no ELSE (null)."""
    c = col_(c)
    expr = None
    for upper, label in bounds:
        expr = (F.when(c < upper, F.lit(label)) if expr is None
                else expr.when(c < upper, F.lit(label)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def safe_ratio(num, den) -> Column:
    """Ratio with zero (or null) denominator -> null, never an ANSI error."""
    return F.try_divide(col_(num), F.nullif(col_(den), F.lit(0)))


def precipitation(c, blank_as_zero: bool = False) -> Column:
    """Weather precipitation text: 'T' (trace) -> 0.0, trailing 's' flag removed.
    A blank field is read as null by the CSV reader; ``blank_as_zero`` maps it to 0.0."""
    c = col_(c)
    zero = c.isin("T", "") | (c.isNull() if blank_as_zero else F.lit(False))
    return F.when(zero, F.lit(0.0)).otherwise(
        F.regexp_replace(c, "s$", "").try_cast("double"))


def integer_temperature(c) -> Column:
    """Weather temperature text: only signed whole numbers are values ('*', '' -> null)."""
    c = col_(c)
    return F.when(c.rlike(r"^-?\d+$"), c.try_cast("double"))


__all__ = ["tolerant_number", "marker_to_null", "strip_chars", "minutes_between", "day_night",
           "bands", "safe_ratio", "hour_start", "precipitation", "integer_temperature", "DECIMAL_RE"]
