"""Repeatable random draws from a hash of the row key.

The value depends on key, seed and stream only, never on partitioning or on which
executor (re)computes the row. One md5 gives four 32-bit lanes.
"""

import math

from pyspark.sql import Column, functions as F

_LANE_DIGITS = 8
_RANGE = float(2**32)


def digest(key: Column | str, seed: int, stream: str) -> Column:
    """md5 of `key:seed:stream`, as 32 hex digits."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(stream)))


def uniform(hexes: Column, lane: int = 0) -> Column:
    """Uniform draw in (0, 1) from one lane of a digest; never 0, so `ln` is safe."""
    word = F.substring(hexes, 1 + _LANE_DIGITS * lane, _LANE_DIGITS)
    return (F.conv(word, 16, 10).cast("double") + F.lit(0.5)) / F.lit(_RANGE)


def between(draw: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + draw * F.lit(float(hi) - float(lo))


def normal_pair(u1: Column, u2: Column) -> tuple[Column, Column]:
    """Two independent standard normal draws (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(u1))
    angle = F.lit(2.0 * math.pi) * u2
    return radius * F.cos(angle), radius * F.sin(angle)
