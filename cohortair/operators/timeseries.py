"""Daily series: filling the calendar and looking back."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


# Rows of an opened calendar (or of its ZIPs) that one task handles.
ROWS_PER_TASK = 200_000


def calendar_rows(
    df: DataFrame, site: str = "aqs_site_id", day: str = "date", fan_out: DataFrame | None = None
) -> int:
    """Rows that opening the calendars makes: per site, the days from its first to its last.

    With `fan_out`, each site's days count once per row it has there (its
    ZIPs, say). One aggregation by site, combined in each task before the
    shuffle, so the measurement costs a scan of two columns.
    """
    spans = df.where(F.col(day).isNotNull()).groupBy(site).agg(
        (F.datediff(F.max(day), F.min(day)) + 1).cast("long").alias("_days")
    )
    if fan_out is not None:
        times = fan_out.where(F.col(site).isNotNull()).groupBy(site).agg(F.count(F.lit(1)).alias("_times"))
        spans = spans.join(times, site).select(site, (F.col("_days") * F.col("_times")).alias("_days"))
    return spans.agg(F.sum("_days")).first()[0] or 0


def partitions_for(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """As many partitions as the opened rows ask for, and at least one per core.

    Given as a number to `repartition`, they are not merged again by adaptive
    execution, which would judge the rows by their size before they open.
    """
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / per_task))


def fill_calendar(
    df: DataFrame, site: str = "aqs_site_id", day: str = "date", partitions: int | None = None
) -> DataFrame:
    """Every day from a site's first to its last, with nulls where it has no row.

    Each row is opened up to the day before the site's next row, which takes
    one shuffle by site and no join. The input holds daily rows, so a site's
    group is never longer than its calendar. `partitions` deals the sites
    over that many tasks first (see `partitions_for`); without it, rows that
    lie by site already stay where they are.
    """
    if partitions is not None:
        df = df.repartition(partitions, site)
    by_site = Window.partitionBy(site).orderBy(day)
    until = F.greatest(F.col(day), F.date_sub(F.lead(day).over(by_site), 1))
    opened = (
        df.where(F.col(day).isNotNull())
        .withColumn("_until", until)
        .withColumn("_day", F.explode(F.sequence(F.col(day), F.col("_until"))))
    )
    values = [
        F.when(F.col("_day") == F.col(day), F.col(c)).alias(c)
        for c in df.columns
        if c not in (site, day)
    ]
    return opened.select(site, F.col("_day").alias(day), *values)


def trailing(
    df: DataFrame,
    days: Sequence[int] = (30, 365),
    site: str = "zip_code",
    day: str = "date",
    value: str = "measurement_avg",
) -> DataFrame:
    """Mean and number of values over the previous n days, the day itself excluded.

    Days are counted as day numbers, so neither the session's time zone nor a
    clock change shifts a window. Each frame adds its own values up, at most n
    per row and oldest first: differences of running sums would be cheaper, but
    lose small values beside large ones and anything after an infinity. Spark
    deals and sorts the rows by site; within a site all days of a frame's
    offset are added at once, so a row costs n additions of an array and not
    n calls. Rows without a day look at each other, as in a range frame.
    """
    added = [
        field
        for n in days
        for field in (
            T.StructField(f"prev_{n}_day_avg", T.DoubleType()),
            T.StructField(f"prev_{n}_days_w_obs", T.LongType()),
        )
    ]
    names, frames = df.columns, tuple(days)

    def look_back(rows):
        import numpy as np
        import pyarrow as pa

        number, held = rows.column("_day_no").combine_chunks(), rows.column("_value").combine_chunks()
        dated = number.is_valid().to_numpy(zero_copy_only=False)
        valued = held.is_valid().to_numpy(zero_copy_only=False)
        number = number.fill_null(0).to_numpy().astype(np.int64)
        held = held.fill_null(0.0).to_numpy()
        first = number[dated].min() if dated.any() else 0
        at = np.where(dated, number - first, 0)
        span = int(at.max()) + 1
        counted = dated & valued
        sums = np.zeros(span)
        out = rows.select(names)
        with np.errstate(all="ignore"):
            np.add.at(sums, at[counted], held[counted])
            until = np.r_[0, np.cumsum(np.bincount(at[counted], minlength=span))]
            undated = held[~dated & valued]
            for n in frames:
                past, total = np.r_[np.zeros(n), sums], np.zeros(span)
                for k in range(n):
                    total += past[k : k + span]
                here = np.arange(span)
                number_of = until[here] - until[np.maximum(here - n, 0)]
                seen = np.where(dated, number_of[at], len(undated))
                mean = np.where(dated, total[at], undated.sum()) / np.maximum(seen, 1)
                out = out.append_column(f"prev_{n}_day_avg", pa.array(mean, pa.float64(), mask=seen == 0))
                out = out.append_column(f"prev_{n}_days_w_obs", pa.array(seen, pa.int64()))
        return out

    numbered = df.withColumns({"_day_no": F.unix_date(F.col(day)), "_value": F.col(value).cast("double")})
    return numbered.groupBy(site).applyInArrow(look_back, T.StructType([*df.schema.fields, *added]))


def spans(df: DataFrame, site: str = "aqs_site_id", day: str = "date") -> DataFrame:
    """First and last day of each site, as `_first` and `_last`."""
    return df.where(F.col(day).isNotNull()).groupBy(site).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))


def span_rows(df: DataFrame, key: str) -> int:
    """Days between the first and the last of each key's spans, added up."""
    of_key = df.groupBy(key).agg((F.datediff(F.max("_last"), F.min("_first")) + 1).cast("long").alias("_days"))
    return of_key.agg(F.sum("_days")).first()[0] or 0
