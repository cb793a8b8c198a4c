"""Daily climate around each person's index date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortair.operators.joins import attach
from cohortair.settings import LAB_INDEX
from cohortair.sources.tables import new_folder, publish

MEASURES = ("MeanTemp", "Precip", "DewPoint")


def stack_years(*years: DataFrame) -> DataFrame:
    """Yearly climate tables as one, matched by column name."""
    return reduce(DataFrame.unionByName, years)


def distinct_zips(df: DataFrame, column: str = "zip_code") -> DataFrame:
    """Distinct values of a ZIP column."""
    return df.select(column).distinct()


def shared_zips(people: DataFrame, climate: DataFrame) -> DataFrame:
    """ZIPs that are in both tables, as `POSTCODE`."""
    of_people = people.select(F.col("zip_code").alias("POSTCODE")).distinct()
    return of_people.join(distinct_zips(climate, "POSTCODE"), "POSTCODE", "left_semi")


def climate_for_zips(climate: DataFrame, zips: DataFrame, ordered: bool = False) -> DataFrame:
    """Climate rows of the given ZIPs, by date if asked for."""
    kept = climate.select("POSTCODE", *MEASURES, "Date").join(zips, "POSTCODE", "left_semi")
    return kept.orderBy("Date") if ordered else kept


def people_with_climate(people: DataFrame, climate: DataFrame) -> DataFrame:
    """People whose ZIP has climate rows, with their index date.

    One row per row of `people`, which holds each person once.
    """
    covered = distinct_zips(climate, "POSTCODE").withColumnRenamed("POSTCODE", "zip_code")
    return (
        people.where(F.col("zip_code").isNotNull())
        .select("person_id", "zip_code", LAB_INDEX)
        .join(covered, "zip_code", "left_semi")
        .select("person_id", "zip_code", LAB_INDEX)
    )


def lag_grid(spark: SparkSession, n: int = 45) -> DataFrame:
    """Whole numbers from -n to n as `time_lag`."""
    return spark.range(-n, n + 1).select(F.col("id").cast("int").alias("time_lag"))


def expand_lags(people: DataFrame, n: int = 45, index_date: str = LAB_INDEX) -> DataFrame:
    """Each row once per lag from -n to n, with the day that lies there."""
    return people.withColumn(
        "time_lag", F.explode(F.sequence(F.lit(-n), F.lit(n)))
    ).withColumn("lag_dates", F.date_add(F.col(index_date), F.col("time_lag")))


def attach_climate(lags: DataFrame, climate: DataFrame) -> DataFrame:
    """Climate of each person's ZIP on each day, and the weekday (1 is Sunday)."""
    measured = climate.select(
        F.col("POSTCODE").alias("zip_code"),
        F.col("Date").alias("lag_dates"),
        F.col("Date").alias("climate_measure_date"),
        *MEASURES,
    )
    return attach(lags, measured, ["zip_code", "lag_dates"]).select(
        "person_id",
        "zip_code",
        LAB_INDEX,
        "time_lag",
        "lag_dates",
        F.dayofweek("lag_dates").alias("day_of_week_num"),
        F.date_format("lag_dates", "E").alias("day_of_week"),
        "climate_measure_date",
        *MEASURES,
    )


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Numbers rows by a distinct key, missing first, without one big task.

    Rows are dealt by ranges of the key, whose bounds Spark takes from the
    data, and stored once with the number of their range in the shared folder.
    Ranges are then counted, and rows numbered within their range.
    """
    spread = df.repartitionByRange(F.col(key).asc_nulls_first())
    dealt = spread.withColumn("_part", F.spark_partition_id())
    stored = publish(dealt, "numbered", new_folder(df.sparkSession))
    ahead = Window.orderBy(F.col("_part").asc()).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_first())
    return (
        stored.join(offsets, "_part")
        .withColumn("row_num", (F.col("_before") + F.row_number().over(within)).cast("int"))
        .drop("_part", "_before")
    )


def unmatched_zips(people: DataFrame, climate: DataFrame, start: int = 1) -> DataFrame:
    """People's ZIPs without climate rows, numbered by ZIP, from number `start` on.

    A missing ZIP counts as unmatched and comes first.
    """
    of_climate = distinct_zips(climate, "POSTCODE").withColumnRenamed("POSTCODE", "zip_code")
    missing = distinct_zips(people).join(of_climate, "zip_code", "left_anti")
    return number_rows(missing, "zip_code").where(F.col("row_num") >= start)


def _fully_measured(table: DataFrame) -> DataFrame:
    return table.where(
        F.col("MeanTemp").isNotNull() & F.col("DewPoint").isNotNull() & F.col("Precip").isNotNull()
    )


def count_covered_people(table: DataFrame) -> DataFrame:
    """Number of people with all three climate values on some day."""
    return _fully_measured(table).agg(F.countDistinct("person_id").alias("n_people"))


def count_unshifted_covered(people: DataFrame, table: DataFrame) -> DataFrame:
    """The same, of people whose site reports no shift of dates."""
    covered = _fully_measured(table).select("person_id").distinct()
    return (
        people.where("shift_date_yn = 'N'")
        .join(covered, "person_id", "left_semi")
        .agg(F.countDistinct("person_id").alias("n_people"))
    )
