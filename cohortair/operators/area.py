"""ZIP and ZCTA tables: crosswalk, area attributes, monitors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.operators.joins import attach
from cohortair.settings import AREA_MEASURES


def zcta_attributes_by_zip(attributes: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Area attributes for every ZIP of each ZCTA."""
    zips = crosswalk.select("ZCTA", F.col("ZIP_CODE").alias("zipcode"))
    return attributes.join(zips, "ZCTA")


def attach_area_attributes(people: DataFrame, by_zip: DataFrame) -> DataFrame:
    """People's cleaned ZIP and id with the attributes of that ZIP."""
    keyed = by_zip.withColumn("zip_code", F.col("zipcode"))
    return attach(people.select("zip_code", "person_id"), keyed, "zip_code")


def attach_disease_count(people: DataFrame, summary: DataFrame) -> DataFrame:
    """Adds `MDs` of each person."""
    return people.join(summary.select("person_id", "MDs"), "person_id", "left")


def attach_zcta(people: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """People with the `ZCTA` of their cleaned ZIP; people without a ZIP have none."""
    zcta = crosswalk.select(F.col("ZIP_CODE").alias("zip_code"), "ZCTA")
    return attach(people, zcta, "zip_code")


def unmatched_areas(people: DataFrame) -> DataFrame:
    """Distinct places of people whose ZIP has no ZCTA."""
    return people.where(F.col("ZCTA").isNull()).select("city", "state", "zip", "ZCTA").distinct()


def cast_measures(df: DataFrame, columns: Sequence[str] = AREA_MEASURES) -> DataFrame:
    """Text columns as doubles; what is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of a column, missing values included."""
    return df.groupBy(key).count()


def zip_zcta_crosswalk(
    base: DataFrame, update: DataFrame, whole_rows: bool = False
) -> DataFrame:
    """Crosswalk and its update as distinct (ZIP, ZCTA) pairs.

    `whole_rows` stacks all columns and keeps repeats.
    """
    if whole_rows:
        return update.unionByName(base)
    pair = ("ZIP_CODE", "ZCTA")
    return base.select(*pair).unionByName(update.select(*pair)).distinct()


def cohort_zips(people: DataFrame, person_id=None, distinct: bool = True) -> DataFrame:
    """Distinct cleaned ZIPs of the cohort, or of one person."""
    if person_id is not None:
        people = people.where(F.col("person_id") == person_id)
    zips = people.select("zip_code")
    return zips.distinct() if distinct else zips


def zips_to_zcta(zips: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """ZCTA of each ZIP, null where it has none."""
    pairs = crosswalk.select(F.col("ZIP_CODE").alias("zip_code"), F.col("ZCTA").alias("zcta"))
    return zips.join(pairs, "zip_code", "left").select("zip_code", "zcta")


def zcta_monitors(pairs: DataFrame, zcta: str | None = None, older: bool = False) -> DataFrame:
    """Monitors inside or near each ZCTA, or near one.

    `older` reads the plain table of (zcta, monitor).
    """
    if older:
        named = pairs.withColumnRenamed("monitor", "aqs_site_id")
    else:
        named = pairs.select(
            F.col("ZCTA").alias("zcta"),
            F.col("Monitor_ID").alias("aqs_site_id"),
            "Distance_m",
            "WithinZCTA",
        )
    return named if zcta is None else named.where(F.col("zcta") == zcta)


def nearby_monitors(zip_zcta: DataFrame, monitors: DataFrame, dedupe: bool = True) -> DataFrame:
    """Monitors near each ZIP of the cohort.

    `dedupe` drops repeated pairs; PM2.5 keeps them.
    """
    near = zip_zcta.select("zip_code", "zcta").distinct().join(monitors, "zcta")
    return near.distinct() if dedupe else near


def monitors_with_data(readings: DataFrame, nearby: DataFrame) -> DataFrame:
    """Distinct nearby monitors that have readings."""
    with_data = readings.select("aqs_site_id").distinct()
    return nearby.select("aqs_site_id").distinct().join(with_data, "aqs_site_id", "left_semi")
