import datetime
import functools
import math
import operator
import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from cohortair.operators import air, checks, timeseries
from cohortair.plans import environment
from cohortair.settings import NO2, PM25, PM25_OLDER, SO2

READING = (
    "aqs_site_id string, DateLocal date, ArithmeticMean double, SampleDuration string, "
    "ObservationCount int, ParameterCode int, ParameterName string, UnitsofMeasure string, "
    "CityName string, StateName string, Latitude double, Longitude double, MethodCode int, "
    "MethodName string"
)


def readings(spark, data, code=42602):
    """Readings from (site, day, value, duration, count[, method])."""
    return spark.createDataFrame(
        [
            (r[0], day(r[1]), r[2], r[3], r[4], code, "name", "unit", "c", "s", 0.0, 0.0,
             r[5] if len(r) > 5 else 1, f"m{r[5] if len(r) > 5 else 1}")
            for r in data
        ],
        READING,
    )


def test_pollutant_by_code_and_duration(spark):
    table = readings(spark, [("m", "2020-01-01", 1.0, "1 HOUR", 24), ("m", "2020-01-01", 1.0, "x", 24)])
    assert air.pollutant(table, 42602).count() == 2
    assert air.pollutant(table, NO2.code, NO2.keep).count() == 1
    assert air.pollutant(table, SO2.code).count() == 0


def test_best_reading_follows_the_highest_count(spark):
    table = air.nullify_below(
        readings(
            spark,
            [("m", "2020-01-01", 1.0, "1 HOUR", 23), ("m", "2020-01-01", 2.0, "1 HOUR", 24),
             ("m", "2020-01-01", 4.0, "1 HOUR", 24),
             # the highest count has no valid value: the day has none
             ("m", "2020-01-02", 1.0, "1 HOUR", 23), ("m", "2020-01-02", -0.1, "1 HOUR", 24),
             # no count at all: the rows drop out
             ("m", "2020-01-03", 1.0, "1 HOUR", None),
             ("m", "2020-01-04", 0.0, "1 HOUR", 1), ("m", "2020-01-04", 9.0, "1 HOUR", None)],
        )
    )
    assert rows(air.best_reading(table)) == [
        ("m", day("2020-01-01"), 3.0), ("m", day("2020-01-02"), None), ("m", day("2020-01-04"), 0.0),
    ]


def test_calendar_fills_between_first_and_last_day(spark):
    daily = spark.createDataFrame(
        [("a", day("2020-02-27"), 1.0), ("a", day("2020-03-02"), 2.0), ("b", day("2020-01-01"), None),
         ("c", day("2020-01-01"), 1.0), ("c", day("2020-01-01"), 2.0), ("c", day("2020-01-02"), 3.0)],
        "aqs_site_id string, date date, measurement double",
    )
    filled = timeseries.fill_calendar(daily)
    assert dict(filled.dtypes)["date"] == "date"
    assert rows(filled.where("aqs_site_id <> 'c'")) == [
        ("a", day("2020-02-27"), 1.0), ("a", day("2020-02-28"), None), ("a", day("2020-02-29"), None),
        ("a", day("2020-03-01"), None), ("a", day("2020-03-02"), 2.0), ("b", day("2020-01-01"), None),
    ]
    assert rows(filled.where("aqs_site_id = 'c'"), "measurement") == [(1.0,), (2.0,), (3.0,)]


def test_pm25_picks_the_first_duration(spark):
    table = readings(
        spark,
        [("m", "2020-01-01", 1.0, "24 HOUR", 1), ("m", "2020-01-01", 3.0, "24 HOUR", 1),
         ("m", "2020-01-01", 9.0, "24-HR BLK AVG", 24), ("m", "2020-01-02", 9.0, "24-HR BLK AVG", 24),
         ("m", "2020-01-02", 7.0, "1 HOUR", 24), ("m", "2020-01-03", 7.0, "1 HOUR", 24),
         ("m", "2020-01-03", 8.0, "1 HOUR", 23), ("m", "2020-01-04", -1.0, "24 HOUR", 1),
         ("m", "2020-01-05", 5.0, "unknown", 1)],
        PM25.code,
    )
    daily = air.daily_series(table, PM25)
    flags = ("measurement_24hr", "measurement_24hr_blk_avg", "measurement_01hr")
    assert rows(daily, "date", "measurement_avg", *flags) == [
        (day("2020-01-01"), 2.0, 1, 0, 0), (day("2020-01-02"), 9.0, 0, 1, 0),
        (day("2020-01-03"), 7.0, 0, 0, 1), (day("2020-01-04"), None, 0, 0, 0),
    ]
    older = air.daily_series(table, PM25_OLDER)
    assert rows(older, "date", "measurement_avg", *flags) == [
        (day("2020-01-01"), 5.5, 1, 1, 0), (day("2020-01-02"), 8.0, 0, 1, 1),
        (day("2020-01-03"), 7.0, 0, 0, 1), (day("2020-01-04"), None, 0, 0, 0),
    ]


def test_older_limit_nullifies_zero(spark):
    table = readings(spark, [("m", "2020-01-01", 0.0, "24 HOUR", 1)], PM25.code)
    assert air.daily_series(table, PM25).first()["measurement_avg"] == 0.0
    assert air.daily_series(table, PM25_OLDER).first()["measurement_avg"] is None


def test_so2_takes_the_best_within_each_duration(spark):
    table = readings(
        spark,
        [("m", "2020-01-01", 1.0, "1 HOUR", 10), ("m", "2020-01-01", 2.0, "1 HOUR", 20),
         ("m", "2020-01-01", 5.0, "3-HR BLK AVG", 24), ("m", "2020-01-02", 6.0, "3-HR BLK AVG", 8),
         ("m", "2020-01-02", -6.0, "1 HOUR", 24)],
        SO2.code,
    )
    columns = ("date", *[d.value for d in SO2.durations], SO2.value, *[d.used for d in SO2.durations])
    assert rows(air.daily_series(table, SO2), *columns) == [
        (day("2020-01-01"), 2.0, 5.0, 2.0, 1, 0), (day("2020-01-02"), None, 6.0, 6.0, 0, 1),
    ]


def test_trailing_excludes_today_and_other_zips(spark):
    data = [("a", day("2020-01-01"), 1.0), ("a", day("2020-01-02"), 3.0), ("a", day("2020-01-31"), 5.0),
            ("a", day("2020-02-01"), None), ("a", day("2020-06-01"), 7.0), ("b", day("2020-01-02"), 99.0)]
    df = spark.createDataFrame(data, "zip_code string, date date, measurement_avg double")
    out = timeseries.trailing(df)
    assert rows(out.where("zip_code = 'a'"), "date", "prev_30_day_avg", "prev_30_days_w_obs",
                "prev_365_day_avg", "prev_365_days_w_obs") == [
        (day("2020-01-01"), None, 0, None, 0), (day("2020-01-02"), 1.0, 1, 1.0, 1),
        (day("2020-01-31"), 2.0, 2, 2.0, 2), (day("2020-02-01"), 4.0, 2, 3.0, 3),
        (day("2020-06-01"), None, 0, 3.0, 3),
    ]


def test_trailing_matches_brute_force_over_a_clock_change(spark):
    rng = random.Random(5)
    first = datetime.date(2019, 9, 1)
    data = []
    for zip_code in ("a", "b"):
        for i in range(500):
            if rng.random() < 0.8:
                value = None if rng.random() < 0.2 else rng.random() * 50
                data.append((zip_code, first + datetime.timedelta(days=i), value))
    df = spark.createDataFrame(data, "zip_code string, date date, measurement_avg double")
    for row in timeseries.trailing(df).collect():
        for n in (30, 365):
            past = [v for z, d, v in data
                    if z == row["zip_code"] and v is not None and 1 <= (row["date"] - d).days <= n]
            assert row[f"prev_{n}_days_w_obs"] == len(past)
            mean = row[f"prev_{n}_day_avg"]
            if past:
                assert math.isclose(mean, sum(past) / len(past), rel_tol=1e-12)
            else:
                assert mean is None


def test_trailing_sums_are_exact_after_large_values(spark):
    first = datetime.date(2020, 1, 1)
    data = [("a", first + datetime.timedelta(days=i), 1e9 / 3 if i < 40 else 0.0) for i in range(120)]
    data += [("n", first, float("nan")), ("n", first + datetime.timedelta(days=1), 1.0),
             ("n", first + datetime.timedelta(days=31), 2.0), ("n", first + datetime.timedelta(days=32), 2.0)]
    out = timeseries.trailing(
        spark.createDataFrame(data, "zip_code string, date date, measurement_avg double"), days=(30,)
    )
    late = out.where("zip_code = 'a' AND date > '2020-03-12'").collect()
    assert late and all(r["prev_30_day_avg"] == 0.0 for r in late)
    with_nan = {r["date"]: r["prev_30_day_avg"] for r in out.where("zip_code = 'n'").collect()}
    assert math.isnan(with_nan[first + datetime.timedelta(days=1)])
    assert with_nan[first + datetime.timedelta(days=31)] == 1.0
    assert with_nan[first + datetime.timedelta(days=32)] == 2.0


@pytest.mark.parametrize("history", [[], [1e300], [0.0, 5e20], [float("inf")]])
def test_trailing_means_of_any_double_equal_brute_force(spark, history):
    first = datetime.date(2020, 1, 1)
    special = [1e15, 1e300, 1e-20, -1e-20, 3e-310, 0.0, 0.0, None, float("inf"), 1.0, -float("inf"),
               2.5, float("nan"), 1e15, 1 / 3, 1e14, -1e14]
    values = history + special + [0.1 * i for i in range(45)] + [1e-12, 0.0]
    data = [("a", first + datetime.timedelta(days=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "zip_code string, date date, measurement_avg double")
    made = {r["date"]: r for r in timeseries.trailing(df, days=(2, 30)).collect()}
    for i, (_, date, _) in enumerate(data):
        for n in (2, 30):
            past = [v for v in values[max(0, i - n) : i] if v is not None]
            mean = made[date][f"prev_{n}_day_avg"]
            assert made[date][f"prev_{n}_days_w_obs"] == len(past)
            if not past:
                assert mean is None
                continue
            # Added up one by one; `sum` would make up for lost bits.
            expected = functools.reduce(operator.add, past, 0.0) / len(past)
            assert math.isclose(mean, expected, rel_tol=1e-12) or (math.isnan(mean) and math.isnan(expected))


def test_a_zip_has_the_smallest_label_of_its_monitors(spark):
    people, crosswalk, pairs = series_inputs(spark)
    data = [("m1", "2020-01-01", 2.0, "1 HOUR", 24), ("m2", "2020-01-01", 4.0, "1 HOUR", 24),
            ("m3", "2020-01-02", 9.0, "1 HOUR", 24)]
    told = readings(spark, data).withColumn(
        "ParameterName", F.when(F.col("aqs_site_id") == "m3", "a").otherwise(F.concat(F.lit("n "), "aqs_site_id"))
    )
    series = environment.pollutant_series(told, people, crosswalk, pairs, NO2)
    assert {r["ParameterName"] for r in series.collect()} == {"n m1"}


def series_inputs(spark):
    people = spark.createDataFrame(
        [("p", "10035"), ("q", "10035"), ("r", None)], "person_id string, zip_code string"
    )
    crosswalk = spark.createDataFrame([("10035", "1")], "ZIP_CODE string, ZCTA string")
    pairs = spark.createDataFrame(
        [("1", "m1", 1, 1), ("1", "m2", 1, 1), ("9", "m3", 1, 1)],
        "ZCTA string, Monitor_ID string, Distance_m int, WithinZCTA int",
    )
    return people, crosswalk, pairs


def test_series_counts_monitors_by_kind(spark):
    data = [("m1", "2020-01-01", 2.0, "1 HOUR", 24), ("m2", "2020-01-01", 4.0, "1 HOUR", 24),
            ("m1", "2020-01-03", 6.0, "1 HOUR", 24), ("m3", "2020-01-02", 9.0, "1 HOUR", 24)]
    people, crosswalk, pairs = series_inputs(spark)
    no2 = environment.pollutant_series(readings(spark, data), people, crosswalk, pairs, NO2)
    assert rows(no2, "meas_date", "measurement_avg", "num_monitors", "prev_30_day_avg") == [
        (day("2020-01-01"), 3.0, 2, None), (day("2020-01-02"), None, 0, 3.0),
        (day("2020-01-03"), 6.0, 1, 3.0),
    ]
    assert no2.first()["ParameterName"] == "name" and no2.first()["zip_code"] == "10035"
    so2 = environment.pollutant_series(readings(spark, data, SO2.code), people, crosswalk, pairs, SO2)
    for row in so2.collect():
        assert row["num_monitors"] == row["num_01hr_obs"] + row["num_03hrblk_obs"]
    older = environment.pollutant_series(
        readings(spark, data, PM25.code), people, crosswalk, pairs, PM25_OLDER
    )
    assert "ParameterName" not in older.columns
    assert rows(older, "meas_date", "pm25_meas_avg", "num_monitors")[1] == (day("2020-01-02"), None, 1)


def test_series_without_readings_is_empty(spark):
    people, crosswalk, pairs = series_inputs(spark)
    no2 = environment.pollutant_series(readings(spark, [], NO2.code), people, crosswalk, pairs, NO2)
    assert no2.count() == 0
    zips = spark.createDataFrame([("10035",)], "zip_code string")
    assert air.label_series(zips, readings(spark, [])).count() == 0


def test_repeats_dropped_before_the_join_as_after_it(spark):
    daily = spark.createDataFrame([("m", 1.0), ("m", 1.0), ("m", 2.0)], "aqs_site_id string, v double")
    nearby = spark.createDataFrame(
        [("m", "1"), ("m", "1"), ("m", "2"), ("m", None)], "aqs_site_id string, zip_code string"
    )
    plain = air.zip_readings(daily, nearby, dedupe=False)
    assert plain.count() == 9
    assert rows(air.zip_readings(daily, nearby)) == rows(plain.distinct())


def test_checks_on_readings(spark):
    table = readings(
        spark,
        [("m", "2020-01-01", -1.0, "1 HOUR", 24, 60), ("m", "2020-01-01", 4.0, "1 HOUR", 24, 566),
         ("m", "2020-01-02", 1.0, "1 HOUR", 24, 60), ("m", "2020-01-03", 2.0, "1 HOUR", 24, 60),
         ("m", "2020-01-03", 3.0, "1 HOUR", 20, 600), ("m", "2020-01-04", 6.0, "1 HOUR", 20, 60),
         ("m", "2020-01-04", 8.0, "1 HOUR", 20, 60), ("m", "2020-01-04", 8.0, "x", None, 60)],
    )
    highest = checks.max_count_check(table)
    assert highest.count() == 8
    assert rows(highest.where("DateLocal = '2020-01-03'"), "ObservationCount", "maxObservationCount") == [
        (20, 24), (24, 24),
    ]
    by_duration = checks.max_count_check(table, ("aqs_site_id", "DateLocal", "SampleDuration"))
    assert by_duration.where("maxObservationCount IS NULL").count() == 1
    assert rows(checks.repeat_readings(table), "DateLocal", "count") == [
        (day("2020-01-01"), 2), (day("2020-01-03"), 2), (day("2020-01-04"), 3),
    ]
    assert rows(checks.compare_methods(table, "m", 42602, "1 HOUR", (60, 566, 600)),
                "MethodCode", "Measurement_Average") == [(566, 4.0), (60, 7.0)]


def test_opened_calendars_keep_a_task_per_core(spark):
    # Ten sites of two readings a year apart: tiny before the calendars open, 3,660 rows after.
    rows_in = [(f"s{i}", day(d), 1.0) for i in range(10) for d in ("2020-01-01", "2020-12-31")]
    df = spark.createDataFrame(rows_in, "aqs_site_id string, date date, v double")
    opened = timeseries.calendar_rows(df)
    assert opened == 10 * 366
    assert timeseries.calendar_rows(df, fan_out=spark.createDataFrame([("s1", "z1"), ("s1", "z2")], "aqs_site_id string, zip_code string")) == 2 * 366
    parts = timeseries.partitions_for(spark, opened, per_task=100)
    assert parts == 37
    filled = timeseries.fill_calendar(df, partitions=parts)
    assert filled.count() == 3660 and filled.rdd.getNumPartitions() == parts
    assert timeseries.partitions_for(spark, 0) == spark.sparkContext.defaultParallelism
    # The trailing frames by site reuse the partitions: no shuffle that adaptive execution could merge.
    looked = timeseries.trailing(filled.withColumnRenamed("v", "measurement_avg"), site="aqs_site_id")
    assert looked.rdd.getNumPartitions() == parts


def test_group_days_equal_days_matched_to_every_zip(spark):
    """Repeated pairs, shared and own ZIPs, null keys and values: the same ZIP days, fewer rows joined."""
    data = [(f"m{i}", f"2020-01-0{1 + (i * j) % 4}", float(i + j), "1 HOUR", 24) for i in range(1, 7) for j in (1, 2, 3)]
    told = readings(spark, data).withColumn("ArithmeticMean", F.when(F.col("ArithmeticMean") != 5, F.col("ArithmeticMean")))
    daily = air.daily_series(told, NO2, labelled=True)
    pairs = [(f"m{i}", z) for i in range(1, 6) for z in ("a", "b")] + [("m1", "a"), ("m6", "c"), ("m6", None), (None, "a")]
    nearby = spark.createDataFrame(pairs, "aqs_site_id string, zip_code string")
    matched = air.zip_daily(air.zip_readings(daily, nearby, dedupe=False), NO2)
    grouped = air.group_daily(daily, nearby, NO2)
    names = ("zip_code", "date", "measurement_avg", "num_monitors", "_label")
    assert rows(grouped, *names) == rows(matched, *names)
    sites, zips = air.site_groups(nearby)
    assert sites.select("_group").distinct().count() == 3 and zips.count() == 5


def test_trailing_frames_of_gaps_repeats_and_missing_days(spark):
    data = [("a", day("2020-01-01"), 1.0, "x"), ("a", day("2020-01-01"), 3.0, "y"), ("a", day("2020-01-04"), None, "z"),
            ("a", day("2020-01-05"), 7.0, "u"), ("a", None, 9.0, "v"), ("a", None, None, "w"), (None, day("2020-01-02"), 5.0, "t")]
    df = spark.createDataFrame(data, "zip_code string, date date, measurement_avg double, other string")
    made = {r["other"]: (r["prev_3_day_avg"], r["prev_3_days_w_obs"]) for r in timeseries.trailing(df, days=(3,)).collect()}
    assert made == {"x": (None, 0), "y": (None, 0), "z": (2.0, 2), "u": (None, 0), "v": (9.0, 1), "w": (9.0, 1), "t": (None, 0)}
