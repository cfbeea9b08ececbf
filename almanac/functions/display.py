"""Numbers as text for report tiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(value: Column, suffix: str = "", decimals: int = 1) -> Column:
    """``1,234.5 C``; a dash where there is no value."""
    text = F.concat(F.format_number(value, decimals), F.lit(suffix))
    return F.when(value.isNull() | F.isnan(value), F.lit("-")).otherwise(text)
