"""Geohash as one closed-form column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The geohash alphabet, and the digits Spark writes base 32 with.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _cell_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Which of 2**bits equal cells holds ``value``; the upper edge belongs to the last cell."""
    cells = 1 << bits
    raw = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(cells))).cast("long")
    return F.greatest(F.lit(0), F.least(raw, F.lit(cells - 1))).cast("long")


def _spread(cell: Column) -> Column:
    """The bits of a number with a zero between each two: its binary digits read in base four."""
    return F.conv(F.bin(cell), 4, 10).cast("long")


def geohash(lat: Column | str, lon: Column | str, precision: int = 6) -> Column:
    """Base-32 cell of a point; null when a coordinate is null or out of range.

    Bits alternate longitude, latitude from the top; five bits make a character. ``conv`` writes the
    number in base 32 with its own digits, which are then exchanged for those of the alphabet.
    """
    if not 1 <= precision <= 12:
        raise ValueError("precision must be between 1 and 12")
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    total = 5 * precision
    x = _spread(_cell_index(lon, -180.0, 360.0, (total + 1) // 2))
    y = _spread(_cell_index(lat, -90.0, 180.0, total // 2))
    # The lowest bit is a latitude bit when the number of bits is even.
    mixed = x * 2 + y if total % 2 == 0 else x + y * 2
    digits = F.lpad(F.conv(mixed.cast("string"), 10, 32), precision, "0")
    valid = lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(valid, F.translate(digits, CONV_DIGITS, BASE32))
