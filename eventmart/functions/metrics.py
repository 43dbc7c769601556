"""Guarded ratios (M1-M3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL when the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))
