"""Column expressions for air readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_below(column: str, limit: float) -> Column:
    """The value, or null where it is below the limit."""
    return F.when(F.col(column) >= limit, F.col(column))


def first_used(columns: Sequence[str]) -> list[Column]:
    """0/1 flag per column: it has a value and no column before it has."""
    flags = []
    earlier = F.lit(False)
    for c in columns:
        present = F.col(c).isNotNull()
        flags.append((present & ~earlier).cast("int"))
        earlier = earlier | present
    return flags


def mean_of_present(columns: Sequence[str]) -> Column:
    """Mean over the columns that have a value, null if none has."""
    total, n = F.lit(0.0), F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
        n = n + F.col(c).isNotNull().cast("int")
    return F.when(n > 0, total / n)
