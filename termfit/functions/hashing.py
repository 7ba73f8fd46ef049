"""Reproducible pseudo-random numbers that depend only on a key.

The value for an id does not depend on partitioning, on row order or on which other
ids exist, so no row numbering and no join is needed to hand out random vectors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits of the digest: every value is exact in a double.
_DIGITS = 13
_RANGE = float(16**_DIGITS)


def hash_integer(*parts: Column) -> Column:
    """BIGINT in [0, 2^52) from the colon-joined parts."""
    digest = F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")


def hash_uniform(*parts: Column) -> Column:
    """Uniform in [-0.5, 0.5)."""
    return hash_integer(*parts) / F.lit(_RANGE) - F.lit(0.5)


def hash_normal(*parts: Column) -> Column:
    """Standard normal (Box-Muller); the half step keeps the logarithm away from zero."""
    radius = (hash_integer(*parts, F.lit(1)) + F.lit(0.5)) / F.lit(_RANGE)
    angle = hash_integer(*parts, F.lit(2)) / F.lit(_RANGE)
    return F.sqrt(F.lit(-2.0) * F.log(radius)) * F.cos(F.lit(2.0 * math.pi) * angle)
