"""String clean-up helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_event_type(col: Column) -> Column:
    """lower(trim(x)); NULL becomes ''."""
    return F.lower(F.trim(F.coalesce(col, F.lit(""))))


def clean_url(col: Column) -> Column:
    """Trim, then drop every whitespace character inside the URL."""
    return F.regexp_replace(F.trim(col), r"\s+", "")


def not_blank(col: Column) -> Column:
    """Not NULL and something other than spaces (``trim`` strips spaces only)."""
    return col.isNotNull() & (F.length(F.trim(col)) > 0)
