"""Tables for looking at the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortair.functions.readings import null_below

VISIT_COLUMNS = (
    "person_id",
    "macrovisit_id",
    "visit_occurrence_id",
    "visit_concept_id",
    "visit_concept_name",
    "visit_start_date",
    "visit_end_date",
    "macrovisit_start_date",
    "macrovisit_end_date",
)

# Fixed value: code of an inpatient visit.
INPATIENT_CODE = 9201


def stay_code_counts(visits: DataFrame, code: int = INPATIENT_CODE) -> DataFrame:
    """Per stay, the number of its visits with a code."""
    return (
        visits.where(F.col("macrovisit_id").isNotNull() & (F.col("visit_concept_id") == code))
        .groupBy("macrovisit_id")
        .agg(F.count("visit_concept_id").alias("multi_inpatient_codes"))
    )


def stay_detail(visits: DataFrame, stay_id, ordered: bool = True) -> DataFrame:
    """All visits of one stay, by visit code."""
    found = visits.select(*VISIT_COLUMNS).where(F.col("macrovisit_id") == stay_id)
    return found.orderBy("visit_concept_id") if ordered else found


def person_stays(visits: DataFrame, person_id, ordered: bool = True) -> DataFrame:
    """All visits of one person that belong to stays, by the stay's start."""
    found = visits.select(*VISIT_COLUMNS).where(
        F.col("macrovisit_id").isNotNull() & (F.col("person_id") == person_id)
    )
    return found.orderBy("macrovisit_start_date") if ordered else found


def max_count_check(
    readings: DataFrame, keys: Sequence[str] = ("aqs_site_id", "DateLocal"), limit: float = 0.0
) -> DataFrame:
    """All readings, each with the highest observation count of its group.

    The highest count is aggregated, partly before the shuffle, and joined
    back, so a group with very many readings is never held by one task, as a
    window would. That reads three columns of the readings a second time.
    """
    rows = readings.select(
        *keys,
        "ObservationCount",
        null_below("ArithmeticMean", limit).alias("ArithmeticMean"),
    )
    highest = readings.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max("ObservationCount").alias("maxObservationCount")
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(highest, same, "left").drop(*[f"_{k}" for k in keys])


def repeat_readings(
    readings: DataFrame, keys: Sequence[str] = ("aqs_site_id", "DateLocal")
) -> DataFrame:
    """Groups with more than one reading and their number."""
    return readings.groupBy(*keys).count().where("count > 1")


def compare_methods(
    readings: DataFrame, site: str, code: int, duration: str, methods: Sequence[int]
) -> DataFrame:
    """Mean reading of each method at one site, over comparable days.

    A day counts if it has more than one reading and all have the same
    observation count. Readings are summed up per day and method first; days
    are judged on these sums.
    """
    per_method = (
        readings.where(
            (F.col("ParameterCode") == code)
            & (F.col("aqs_site_id") == site)
            & (F.col("SampleDuration") == duration)
            & F.col("DateLocal").isNotNull()
        )
        .withColumn("_value", null_below("ArithmeticMean", 0.0))
        .groupBy("DateLocal", "MethodName", "MethodCode")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("_value").alias("total"),
            F.count("_value").alias("n"),
            F.min("ObservationCount").alias("low"),
            F.max("ObservationCount").alias("high"),
        )
    )
    day = Window.partitionBy("DateLocal")
    return (
        per_method.withColumns(
            {
                "rows": F.sum("rows").over(day),
                "low": F.min("low").over(day),
                "high": F.max("high").over(day),
            }
        )
        .where((F.col("rows") > 1) & (F.col("low") == F.col("high")))
        .where(F.col("MethodCode").isin(*methods))
        .groupBy("MethodName", "MethodCode")
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("Measurement_Average"))
    )
