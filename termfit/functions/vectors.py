"""Dense vectors in ARRAY<DOUBLE> columns, named by SQL references such as ``u``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many elements are written out one by one, which keeps the arithmetic in
# generated code of a size that the JVM still compiles.
UNROLL_LIMIT = 20


def dot(u: str, v: str, d: int | None = None, offset: int = 0, unroll: bool | None = None) -> Column:
    """Inner product of whole vectors, or of the d elements from ``offset`` on."""
    if d is None:
        return _fold(u, v)
    if unroll is None:
        unroll = d <= UNROLL_LIMIT
    if unroll:
        return F.expr(" + ".join(f"{u}[{k}] * {v}[{k}]" for k in range(offset, offset + d)))
    return _fold(f"slice({u}, {offset + 1}, {d})", f"slice({v}, {offset + 1}, {d})")


def _fold(u: str, v: str) -> Column:
    return F.expr(f"aggregate(zip_with({u}, {v}, (a, b) -> a * b), 0D, (s, x) -> s + x)")
