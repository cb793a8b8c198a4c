"""Opening dates into the days around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def days_around(df: DataFrame, date: str, before: int, after: int, day: str) -> DataFrame:
    """One row per day from `before` days ahead of a date to `after` days past it.

    Makes a range condition on dates an equality: rows meet their match by
    (person, day), so a person with very many rows is spread over days instead
    of meeting in one task. Rows without a date have no days.

    Spark's size estimate does not know that rows multiply here, so a later
    join is told to sort: the days are never broadcast by mistake.
    """
    span = F.sequence(F.date_sub(F.col(date), before), F.date_add(F.col(date), after))
    return df.withColumn(day, F.explode(span)).hint("merge")
