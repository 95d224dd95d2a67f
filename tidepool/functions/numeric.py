"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(col, scale: int = 2) -> Column:
    """Round a double half away from zero on ``x * 10^scale``.

    ``F.round`` rounds the shortest decimal text of the double, so a value
    stored as 0.0049999999 may round up; scaling first rounds the binary value
    itself, which is what most SQL engines do for DOUBLE.
    """
    c = F.col(col) if isinstance(col, str) else col
    m = float(10 ** scale)
    return F.round(c * F.lit(m), 0) / F.lit(m)
