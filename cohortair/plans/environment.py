"""From people's ZIPs to daily climate and air-quality series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.operators import air, area, climate, timeseries
from cohortair.settings import Pollutant
from cohortair.sources.tables import new_folder, publish


def climate_by_lag(people: DataFrame, years: Sequence[DataFrame], n: int = 45) -> DataFrame:
    """Climate of each person's ZIP on each day around the index date."""
    daily = climate.stack_years(*years)
    lags = climate.expand_lags(climate.people_with_climate(people, daily), n)
    return climate.attach_climate(lags, daily)


def pollutant_series(
    readings: DataFrame,
    people: DataFrame,
    crosswalk: DataFrame,
    pairs: DataFrame,
    kind: Pollutant,
    days: Sequence[int] = (30, 365),
) -> DataFrame:
    """Daily series of one pollutant for every ZIP of the cohort.

    Only monitors near the cohort are reduced to days and filled; readings are
    scanned once for their first and last days and once for their values.
    """
    of_kind = air.pollutant(readings, kind.code, kind.keep)
    zip_zcta = area.zips_to_zcta(area.cohort_zips(people), crosswalk)
    nearby = area.nearby_monitors(zip_zcta, area.zcta_monitors(pairs), kind.dedupe)
    near = air.near_readings(of_kind, nearby)
    # Tasks as the opened rows ask for: each site's calendar, and the days of each ZIP's monitors. Readings
    # are scanned once for both.
    folder = new_folder(readings.sparkSession)
    spans = publish(timeseries.spans(near, air.SITE, "DateLocal"), "spans", folder)
    site_tasks = timeseries.partitions_for(readings.sparkSession, timeseries.span_rows(spans, air.SITE))
    located = nearby.where(F.col("zip_code").isNotNull()).select("zip_code", air.SITE).distinct()
    opened = timeseries.span_rows(spans.join(located, air.SITE), "zip_code")
    zip_tasks = timeseries.partitions_for(readings.sparkSession, opened)
    # Monitor days are distinct by construction and so is `nearby` where it
    # matters, so no repeats are left to drop.
    daily = air.daily_series(near, kind, kind.labelled, site_tasks)
    return air.zip_series(air.group_daily(daily, nearby, kind), kind, days, zip_tasks)
