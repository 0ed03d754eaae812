"""Small display helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names, each 1024 times the one before.
BYTE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB"]


def format_bytes(size: Column) -> Column:
    """Byte count with two decimals and a binary unit, up to TiB."""
    value = size.cast("double")
    text = F.lit(None).cast("string")
    for power in range(len(BYTE_UNITS) - 1, -1, -1):
        scaled = F.call_function("format_number", value / float(1024 ** power), F.lit("0.00"))
        shown = F.concat(scaled, F.lit(" " + BYTE_UNITS[power]))
        # The largest unit takes everything the smaller ones do not.
        text = shown if power == len(BYTE_UNITS) - 1 else F.when(value < float(1024 ** (power + 1)), shown).otherwise(text)
    return text


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back; negative zero becomes zero."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale + F.lit(0.0)
