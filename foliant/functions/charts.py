"""Text shown on charts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hover_text(point: Column, text: Column | None = None, limit: int = 100) -> Column:
    """First ``limit`` characters and ``...``; ``Point <n>`` without a text."""
    fallback = F.concat(F.lit("Point "), point.cast("string"))
    if text is None:
        return fallback
    return F.coalesce(F.concat(F.substring(text, 1, limit), F.lit("...")), fallback)
