"""Column expressions that parse landing text the way the validator's language does.

All of these are built-in Catalyst expressions (regex gates + ``try_cast``), so
they stay inside whole-stage codegen and never call Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grammar of a decimal number accepted by Python's float(): optional blanks and
# sign, digit groups joined by single underscores, optional fraction/exponent.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    r"[+-]?(?:(?:" + _DIGITS + r")?\." + _DIGITS + r"|" + _DIGITS + r"\.?)"
    r"(?:[eE][+-]?" + _DIGITS + r")?"
)
NUMBER_PATTERN = r"^\s*" + _NUMBER + r"\s*\z"
# Same grammar with the number captured: regexp_extract gives "" when it does not match.
NUMBER_CAPTURE = r"^\s*(" + _NUMBER + r")\s*\z"
INF_PATTERN = r"(?i)^\s*[+-]?inf(?:inity)?\s*\z"
NAN_PATTERN = r"(?i)^\s*[+-]?nan\s*\z"

# ISO date with an optional time part (T or blank separator, no offset).
_ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?)?)?"
ISO_TIMESTAMP_PATTERN = r"^" + _ISO + r"\z"
ISO_CAPTURE = r"^(" + _ISO + r")\z"


def clean_number_text(text: Column) -> Column:
    """Number text without blanks and digit-group underscores; "" when not a number
    (which every cast turns into NULL).  References ``text`` once, so a pushed-down
    filter over a computed column does not recompute it."""
    return F.regexp_replace(F.regexp_extract(text, NUMBER_CAPTURE, 1), "_", "")


def parse_double(text: Column) -> Column:
    """Python-float-compatible parse: numbers, +-inf; NaN and junk give NULL."""
    inf = F.when(F.trim(text).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(text.rlike(INF_PATTERN), inf)
        .otherwise(clean_number_text(text).try_cast("double"))
    )


def parse_amount(text: Column) -> Column:
    """Exact DECIMAL(12,2) from the number text (HALF_UP); NULL when out of range."""
    return clean_number_text(text).try_cast("decimal(12,2)")


def parse_timestamp(text: Column) -> Column:
    """Naive ISO text -> TIMESTAMP_NTZ (session-time-zone independent); NULL if not ISO.
    References ``text`` once (the captured match, "" otherwise, is cast)."""
    return F.regexp_extract(text, ISO_CAPTURE, 1).try_cast("timestamp_ntz")


def epoch_seconds(ts_ntz: Column) -> Column:
    """Whole seconds since 1970-01-01 of a naive UTC timestamp (floor, exact integer)."""
    return (
        F.unix_date(F.to_date(ts_ntz)).cast("long") * F.lit(86400)
        + F.hour(ts_ntz) * F.lit(3600)
        + F.minute(ts_ntz) * F.lit(60)
        + F.second(ts_ntz)
    )


def python_float_text(value: Column) -> Column:
    """Render a double the way Python's repr(float) does (e.g. -50.0, 150000.0, inf, 1e-05)."""
    fixed = F.regexp_replace(
        F.regexp_replace(value.cast("decimal(38,18)").cast("string"), "0+\\z", ""),
        "\\.\\z",
        ".0",
    )
    java = value.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0\z", "")
    exponent = F.regexp_extract(java, r"E(-?[0-9]+)\z", 1).cast("int")
    scientific = F.format_string("%se%+03d", mantissa, exponent)
    magnitude = F.abs(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(value == 0, F.lit("0.0"))
        .when((magnitude >= 1e-4) & (magnitude < 1e16), fixed)
        .otherwise(scientific)
    )
