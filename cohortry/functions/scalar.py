"""Small column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return a / F.nullif(b.cast("double"), F.lit(0.0))
