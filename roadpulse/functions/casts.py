"""Null-safe conversions. All of them hold under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schema import TIMESTAMP_PATTERN

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def safe_double(text: Column) -> Column:
    """Text to double, null on anything that is not a plain decimal number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Text to int by truncation, so ``66.0`` and ``66.9`` give 66."""
    return safe_double(text).try_cast("int")


def parse_timestamp(text: Column) -> Column:
    """One of the accepted forms, read in the session zone (UTC), else null.

    The forms are told apart by shape, so a plain cast parses them; a formatter per form
    would raise and catch an exception for every mismatch.
    """
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp"))


def to_utc(text: Column) -> Column:
    """Any accepted or ISO form, with or without ``Z`` or an offset."""
    return F.coalesce(F.try_to_timestamp(text), parse_timestamp(text))


def typed_timestamp(value: Column, text: Column) -> Column:
    """One timestamp out of a typed and a textual copy of the same moment."""
    return F.coalesce(value, to_utc(text))


def round_dec(value: Column, digits: int) -> Column:
    """Half-up decimal rounding, which gives the same digits in every engine.

    Decimal(18,8) is exact for everything measured here; larger magnitudes have no
    fraction worth the wider type and take the plain form.
    """
    exact = F.round(value.try_cast("decimal(18,8)"), digits).cast("double")
    return F.when(F.abs(value) < 1e9, exact).otherwise(F.round(value, digits))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100``, 0.0 when there is nothing to divide by."""
    return F.when(whole > 0, round_dec(part * F.lit(100.0) / whole, digits)).otherwise(F.lit(0.0))
