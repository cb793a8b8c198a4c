"""Daily air quality per monitor and per ZIP."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortair.functions.readings import first_used, mean_of_present, null_below
from cohortair.operators.joins import broadcast_if_small
from cohortair.operators.timeseries import calendar_rows, fill_calendar, partitions_for, trailing
from cohortair.settings import Duration, Pollutant

SITE = "aqs_site_id"
LABEL = ("ParameterName", "ParameterCode", "UnitsofMeasure")
READING_COLUMNS = (
    SITE,
    "DateLocal",
    "ArithmeticMean",
    "UnitsofMeasure",
    "SampleDuration",
    "ObservationCount",
    "ParameterCode",
    "ParameterName",
    "CityName",
    "StateName",
    "Latitude",
    "Longitude",
)


def pollutant(readings: DataFrame, code: int, durations: Sequence[str] | None = None) -> DataFrame:
    """Readings of one pollutant, of the given sample durations or all."""
    kept = readings.select(*READING_COLUMNS).where(F.col("ParameterCode") == code)
    return kept if durations is None else kept.where(F.col("SampleDuration").isin(*durations))


def nullify_below(df: DataFrame, column: str = "ArithmeticMean", limit: float = 0.0) -> DataFrame:
    """Values below the limit become null; their rows stay."""
    return df.withColumn(column, null_below(column, limit))


def _label(labelled: bool) -> list:
    """The smallest name, code and unit of a group, carried along as `_label` if asked for."""
    if not labelled:
        return []
    return [F.min(F.struct(*LABEL)).alias("_label")]


def _mean_per_count(
    df: DataFrame, keys: Sequence[str], labelled: bool = False, partitions: int | None = None
) -> DataFrame:
    """Mean per group and observation count, gathered by site.

    Readings are averaged before the shuffle by site. What a site then holds
    is bounded by its days and the counts a day can have. `partitions` fixes
    the number of tasks by site, for the calendars opened later in them.
    """
    means = (
        df.where(F.col("ObservationCount").isNotNull())
        .groupBy(*keys, "ObservationCount")
        .agg(F.avg("ArithmeticMean").alias("_mean"), *_label(labelled))
    )
    return means.repartition(keys[0]) if partitions is None else means.repartition(partitions, keys[0])


def _least_label(labelled: bool) -> list:
    return [F.min("_label").alias("_label")] if labelled else []


def best_reading(
    df: DataFrame,
    keys: Sequence[str] = (SITE, "DateLocal"),
    value: str = "measurement",
    labelled: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Mean of the readings that share the group's highest observation count.

    A null reading with the highest count makes no other one count; readings
    without a count are left out.
    """
    return (
        _mean_per_count(df, keys, labelled, partitions)
        .groupBy(*keys)
        .agg(F.max_by("_mean", "ObservationCount").alias(value), *_least_label(labelled))
    )


def best_by_duration(
    df: DataFrame, durations: Sequence[Duration], labelled: bool = False, partitions: int | None = None
) -> DataFrame:
    """`best_reading` within each duration, one column per duration."""
    listed = df.where(F.col("SampleDuration").isin(*[d.label for d in durations]))
    best = []
    for d in durations:
        count = F.when(F.col("SampleDuration") == d.label, F.col("ObservationCount"))
        best.append(F.max_by(F.col("_mean"), count).alias(d.value))
    return (
        _mean_per_count(listed, (SITE, "DateLocal", "SampleDuration"), labelled, partitions)
        .groupBy(SITE, F.col("DateLocal").alias("date"))
        .agg(*best, *_least_label(labelled))
    )


def daily_by_duration(
    df: DataFrame, durations: Sequence[Duration], labelled: bool = False, partitions: int | None = None
) -> DataFrame:
    """Mean of all readings of a site and day, one column per duration.

    A duration may ask for a certain observation count. With `partitions`,
    readings are dealt by site over that many tasks before they are averaged.
    """
    counted, means = F.lit(False), []
    for d in durations:
        holds = F.col("SampleDuration") == d.label
        if d.needs_count is not None:
            holds = holds & (F.col("ObservationCount") == d.needs_count)
        counted = counted | holds
        means.append(F.avg(F.when(holds, F.col("ArithmeticMean"))).alias(d.value))
    kept = df.where(counted)
    if partitions is not None:
        kept = kept.repartition(partitions, SITE)
    by_day = kept.groupBy(SITE, F.col("DateLocal").alias("date"))
    return by_day.agg(*means, *_label(labelled))


def pick_duration(df: DataFrame, durations: Sequence[Duration], value: str) -> DataFrame:
    """First duration with a value, in the given order, and which one it was."""
    columns = [d.value for d in durations]
    flags = first_used(columns)
    return df.withColumns(
        {value: F.coalesce(*columns), **{d.used: f for d, f in zip(durations, flags)}}
    )


def mean_duration(df: DataFrame, durations: Sequence[Duration], value: str) -> DataFrame:
    """Mean over the durations that have a value, and which ones have."""
    return df.withColumns(
        {
            value: mean_of_present([d.value for d in durations]),
            **{d.used: F.col(d.value).isNotNull().cast("int") for d in durations},
        }
    )


def daily_series(
    readings: DataFrame, kind: Pollutant, labelled: bool = False, partitions: int | None = None
) -> DataFrame:
    """One row per monitor and calendar day of one pollutant's readings.

    `labelled` carries each day's smallest label along as `_label`. The sites
    are dealt over `partitions` tasks; without it, as many as the opened
    calendars ask for (`calendar_rows`, one small aggregation of the readings'
    sites and days), so that no task is left with the calendars of all sites.
    """
    valid = nullify_below(readings, limit=kind.limit)
    if partitions is None:
        rows = calendar_rows(valid.select(SITE, "DateLocal"), SITE, "DateLocal")
        partitions = partitions_for(readings.sparkSession, rows)
    if not kind.durations:
        daily = best_reading(valid, value=kind.value, labelled=labelled, partitions=partitions)
        return fill_calendar(daily.withColumnRenamed("DateLocal", "date"))
    by_duration = best_by_duration if kind.within_day == "best" else daily_by_duration
    filled = fill_calendar(by_duration(valid, kind.durations, labelled, partitions))
    choose = pick_duration if kind.between == "first" else mean_duration
    return choose(filled, kind.durations, kind.value)


def zip_readings(daily: DataFrame, nearby: DataFrame, dedupe: bool = True) -> DataFrame:
    """Monitor days matched to the ZIPs nearby.

    Repeats are dropped on either side: with all columns kept, that leaves the
    same rows as dropping them from the much larger result.

    Monitor days lie by site already, so the ZIPs of a site, which are few,
    are brought to them and looked up there. Without the hint Spark may judge
    the filled calendar by its size before filling and broadcast it.
    """
    located = nearby.where(F.col("zip_code").isNotNull())
    if dedupe:
        daily, located = daily.distinct(), located.distinct()
    return daily.join(located.hint("shuffle_hash"), SITE)


def zip_daily(readings: DataFrame, kind: Pollutant) -> DataFrame:
    """Per ZIP and day: mean, number of monitors, number of each duration used."""
    counts = [F.sum(d.used).alias(d.counted) for d in kind.durations]
    monitors = {
        "values": F.count(kind.value),
        "rows": F.count("date"),
        "flags": sum((F.sum(d.used) for d in kind.durations), F.lit(0)),
    }[kind.monitors]
    labels = _least_label("_label" in readings.columns)
    return readings.groupBy("zip_code", "date").agg(
        F.avg(kind.value).alias(kind.area_value), monitors.alias("num_monitors"), *counts, *labels
    )


def site_groups(nearby: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sites that serve the same ZIPs as one group: (site, _group) and (_group, zip_code, _times).

    A group is named by its smallest site; `_times` is how often a ZIP names
    each of its sites, so repeats keep their weight.
    """
    located = nearby.where(F.col("zip_code").isNotNull() & F.col(SITE).isNotNull())
    times = located.groupBy(SITE, "zip_code").agg(F.count(F.lit(1)).alias("_times"))
    sites = times.groupBy(SITE).agg(F.sort_array(F.collect_list(F.struct("zip_code", "_times"))).alias("_zips"))
    groups = sites.groupBy("_zips").agg(F.min(SITE).alias("_group"))
    return (
        sites.join(groups, "_zips").select(SITE, "_group"),
        groups.select("_group", F.inline("_zips")),
    )


def group_daily(daily: DataFrame, nearby: DataFrame, kind: Pollutant) -> DataFrame:
    """The same rows as `zip_daily` of `zip_readings`, without opening a site's days once per ZIP.

    Days are added up per group of sites that serve the same ZIPs, in each task
    before any shuffle; only a group's days, no longer its sites', meet its
    ZIPs. So ZIP days cost what groups and days ask for, however many monitors
    a ZIP has.
    """
    sites, zips = site_groups(nearby)
    flags = [d.used for d in kind.durations]
    labels = _least_label("_label" in daily.columns)
    by_group = (
        daily.join(sites.hint("shuffle_hash"), SITE)
        .groupBy("_group", "date")
        .agg(
            F.sum(kind.value).alias("_sum"),
            F.count(kind.value).alias("_values"),
            F.count("date").alias("_rows"),
            *[F.sum(f).alias(f) for f in flags],
            *labels,
        )
    )

    def total(column: str):
        return F.sum(F.col(column) * F.col("_times"))

    monitors = {
        "values": total("_values"),
        "rows": total("_rows"),
        "flags": sum((total(f) for f in flags), F.lit(0)),
    }[kind.monitors]
    return by_group.join(zips, "_group").groupBy("zip_code", "date").agg(
        (total("_sum") / F.nullif(total("_values"), F.lit(0))).alias(kind.area_value),
        monitors.alias("num_monitors"),
        *[total(d.used).alias(d.counted) for d in kind.durations],
        *labels,
    )


def label_series(df: DataFrame, readings: DataFrame) -> DataFrame:
    """Adds the pollutant's name, code and unit as one reading gives them.

    The three are looked up once as a single value. Without readings there is
    none and the result is empty.
    """
    label = readings.agg(
        F.min(F.struct("ParameterName", "ParameterCode", "UnitsofMeasure")).alias("label")
    )
    return (
        df.withColumn("_label", label.scalar())
        .where(F.col("_label").isNotNull())
        .select("*", "_label.*")
        .drop("_label")
    )


def near_readings(
    readings: DataFrame, nearby: DataFrame, small: bool | None = None
) -> DataFrame:
    """Readings of the monitors nearby.

    Whole monitors go, so the calendars of the others stay as they are. The
    monitors' ids are sent to the readings if they measure small.
    """
    located = nearby.where(F.col("zip_code").isNotNull())
    sites = broadcast_if_small(located.select(SITE).distinct(), small=small)
    return readings.join(sites, SITE, "left_semi")


def zip_series(
    by_zip: DataFrame, kind: Pollutant, days: Sequence[int] = (30, 365), partitions: int | None = None
) -> DataFrame:
    """Daily series per ZIP with its trailing means, labelled, from `zip_daily` or `group_daily`.

    The label comes with the monitor days, so readings are not scanned again:
    a ZIP has the smallest name, code and unit among the readings that count
    of its own monitors. With `partitions`, ZIP days are dealt by ZIP over
    that many tasks, and the label and trailing frames of a ZIP all run there
    without another shuffle.
    """
    if partitions is not None:
        by_zip = by_zip.repartition(partitions, "zip_code")
    if kind.labelled:
        of_zip = Window.partitionBy("zip_code")
        by_zip = by_zip.withColumn("_label", F.min("_label").over(of_zip))
    looked = trailing(by_zip, days, value=kind.area_value)
    if kind.labelled:
        looked = looked.select("*", "_label.*")
    head = ["zip_code", F.col("date").alias("meas_date")]
    label = list(LABEL) if kind.labelled else []
    counts = [d.counted for d in kind.durations]
    past = [c for n in days for c in (f"prev_{n}_day_avg", f"prev_{n}_days_w_obs")]
    return looked.select(*head, *label, kind.area_value, "num_monitors", *counts, *past)
