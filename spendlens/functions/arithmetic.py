from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_sql(numerator: str, denominator: str) -> str:
    """numerator / denominator as doubles, or 0 where the denominator is missing or not positive."""
    ratio = f"CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE)"
    return f"coalesce(CASE WHEN {denominator} > 0 THEN {ratio} END, 0D)"


def safe_ratio(numerator: str, denominator: str) -> Column:
    """The ratio of two columns, by name, or of two SQL expressions; see ratio_sql."""
    return F.expr(ratio_sql(numerator, denominator))
