"""Exact decimal text as columns: nothing is ever rounded to fit, inexact values become null or false."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the canonical layout.
PRICE_SCALE, VOLUME_SCALE, TURNOVER_SCALE, RATE_SCALE = 8, 4, 12, 18
PRECISION, BUCKETS = 38, 8
LARGEST_LONG = 9_223_372_036_854_775_807
LARGEST_ID = 4_294_967_295

_PLAIN = r"^[+-]?[0-9]+(\.[0-9]+)?$"
_UNSIGNED = r"^[+]?[0-9]+(\.[0-9]+)?$"


def is_decimal_text(text: Column, signed: bool = True) -> Column:
    """Whether the text is a plain decimal number without exponent; false for null."""
    return F.coalesce(F.regexp_like(text, F.lit(_PLAIN if signed else _UNSIGNED)), F.lit(False))


def decimal_places(text: Column) -> Column:
    """Significant decimals of exact decimal text: trailing zeros don't count. Null for other text."""
    tail = F.when(F.instr(text, ".") > 0, F.regexp_replace(F.substring_index(text, ".", -1), "0+$", "")).otherwise(F.lit(""))
    return F.when(is_decimal_text(text), F.length(tail))


def whole_digits(text: Column) -> Column:
    """Digits before the point without leading zeros."""
    head = F.regexp_replace(F.substring_index(text, ".", 1), "^[+-]?0*", "")
    return F.when(is_decimal_text(text), F.length(head))


def fits_decimal(text: Column, scale: int, precision: int = PRECISION, signed: bool = False) -> Column:
    """Whether exact text is representable with this precision and scale."""
    return is_decimal_text(text, signed) & (decimal_places(text) <= scale) & (whole_digits(text) <= precision - scale)


def price_units(text: Column, signed: bool = False) -> Column:
    """Price text as a long count of 1e-8 units; null unless exact, in range and positive (signed: of any sign, or 0)."""
    exact = fits_decimal(text, PRICE_SCALE, signed=signed)
    parts = F.rpad(F.when(F.instr(text, ".") > 0, F.substring_index(text, ".", -1)).otherwise(F.lit("")), PRICE_SCALE, "0")
    joined = F.concat(F.regexp_replace(F.substring_index(text, ".", 1), "^[+]", ""), F.substring(parts, 1, PRICE_SCALE))
    units = joined.try_cast("decimal(38,0)")
    lowest = units >= F.lit(-LARGEST_LONG).cast("decimal(38,0)") if signed else units > 0
    return F.when(exact & lowest & (units <= F.lit(LARGEST_LONG).cast("decimal(38,0)")), units.cast("long"))


def units_to_decimal(units: Column, scale: int) -> Column:
    """A long count of 10**-scale units as an exact decimal."""
    return (units.cast("decimal(19,0)") / F.lit(10**scale).cast("decimal(19,0)")).cast(f"decimal(38,{scale})")


def decimal_text(text: Column) -> Column:
    """Decimal text without exponent and trailing zeros."""
    return F.when(F.instr(text, ".") > 0, F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def stable_bucket(instrument_id: Column) -> Column:
    """id modulo BUCKETS for ids from 1 to 2**32 - 1, else null."""
    return F.when((instrument_id >= 1) & (instrument_id <= LARGEST_ID), F.pmod(instrument_id, F.lit(BUCKETS)))


def tick_round(units: Column, tick: Column, up: bool = False) -> Column:
    """Units down (or up) to a multiple of the tick, in whole units."""
    down = units - F.pmod(units, tick)
    return F.when(F.pmod(units, tick) == 0, units).otherwise(down + tick) if up else down


def row_digest(*columns: str) -> Column:
    """SHA-256 of a row's columns as JSON with sorted keys, every value as text; nulls are left out."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)])).cast("binary"), 256)


def symbol_token(text: Column) -> Column:
    """Upper-case letters and digits only."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def joined_text(*parts: Column) -> Column:
    """Null-safe text of several columns in upper case, arrays joined too."""
    return F.upper(F.concat_ws(" ", *parts))
