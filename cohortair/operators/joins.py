"""Joins that stay even when keys are missing or hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
NULL_SPREAD = 256


def measured_bytes(df: DataFrame) -> int:
    """Bytes held by a table, from one distributed aggregate over it."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            width = width + 16
    return df.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table, measured now, is small enough to be broadcast."""
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, small: bool | None = None
) -> DataFrame:
    """Hint a broadcast, but only after measuring the table.

    For code lists cut out of a larger table: Spark's own estimate there is
    the size of the uncut table. A list over the bound comes back unchanged
    and Spark joins it by sorting, with skewed partitions split. `small` is
    the answer where a table that holds this one was measured already.
    """
    if small is None:
        small = fits_broadcast(df, max_bytes)
    return F.broadcast(df) if small else df


def attach(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], spread_over: int = NULL_SPREAD
) -> DataFrame:
    """Left join on keys that may be missing.

    Rows without a key match nothing, yet would all go to one task. A second
    key spreads them over up to `spread_over` tasks; rows with a key carry 0
    there and join as usual.
    """
    keys = [on] if isinstance(on, str) else list(on)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    spread = F.when(
        missing, F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(spread_over))
    ).otherwise(F.lit(0).cast("long"))
    # Always 0, but worked out from the keys: a literal would be folded into
    # a filter and would no longer be a key that rows are shuffled by.
    zero = F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(1))
    return (
        left.withColumn("_spread", spread)
        .join(right.withColumn("_spread", zero), [*keys, "_spread"], "left")
        .drop("_spread")
    )
