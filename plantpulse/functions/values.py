"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grams per weighing unit code (kilogram, gram, tonne, pound).
UNIT_GRAMS = {0: 1000.0, 1: 1.0, 2: 1_000_000.0, 3: 453.59237}

# E-mark tolerance by nominal weight in grams. Each entry is
# (above, up to and including, grams, share of the nominal weight).
TOLERANCE_BANDS = [
    (5, 50, None, 0.09),
    (50, 100, 4.5, None),
    (100, 200, None, 0.045),
    (200, 300, 9.0, None),
    (300, 500, None, 0.03),
    (500, 1000, 15.0, None),
    (1000, 10000, None, 0.015),
    (10000, 15000, 150.0, None),
    (15000, None, None, 0.01),
]


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL for a zero divisor."""
    return top / F.nullif(bottom, F.lit(0))


def fixed(x: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero."""
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def grams_per_unit(code: Column) -> Column:
    """Gram factor of a unit code; NULL for an unknown code."""
    expr = F.lit(None).cast("double")
    for value, grams in UNIT_GRAMS.items():
        expr = F.when(code == value, F.lit(grams)).otherwise(expr)
    return expr


def tolerance_grams(nominal: Column) -> Column:
    """First tolerance limit in grams; NULL at or below the smallest band."""
    expr = F.lit(None).cast("double")
    for low, high, grams, share in TOLERANCE_BANDS:
        inside = nominal > low if high is None else (nominal > low) & (nominal <= high)
        value = F.lit(grams) if grams is not None else nominal * F.lit(share)
        expr = F.when(inside, value).otherwise(expr)
    return expr


def pretty_bytes(size: Column) -> Column:
    """Byte count in the largest unit that still shows at least 10 of it."""
    units = ["bytes", "kB", "MB", "GB", "TB"]
    text = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in enumerate(units[1:], start=1):
        scaled = F.floor(size / F.lit(1024**power) + F.lit(0.5)).cast("bigint").cast("string")
        text = F.when(size >= F.lit(10 * 1024**power), F.concat(scaled, F.lit(f" {unit}"))).otherwise(text)
    return text
