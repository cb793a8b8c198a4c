from conftest import day, rows

from cohortair.operators import area, climate
from cohortair.plans import environment


def people(spark):
    return spark.createDataFrame(
        [("a", "10035", day("2020-06-10"), "N"), ("b", "99999", day("2020-06-10"), "N"),
         ("c", None, day("2020-06-10"), "N"), ("d", "10035", day("2020-12-01"), "Y")],
        "person_id string, zip_code string, first_pos_pcr_antigen_date date, shift_date_yn string",
    )


def weather(spark):
    return spark.createDataFrame(
        [("10035", day("2020-06-10"), 20.0, 1.0, 10.0), ("10035", day("2020-07-25"), 25.0, 0.0, None),
         ("20001", day("2020-06-10"), 1.0, 1.0, 1.0), ("10035", day("2020-12-02"), 0.0, 1.0, 2.0)],
        "POSTCODE string, Date date, MeanTemp double, Precip double, DewPoint double",
    )


def test_grid_has_91_days_per_covered_person(spark):
    table = environment.climate_by_lag(people(spark), [weather(spark)])
    assert table.groupBy("person_id").count().collect() and rows(
        table.groupBy("person_id").count()
    ) == [("a", 91), ("d", 91)]
    hit = table.where("person_id = 'a' AND MeanTemp IS NOT NULL").select(
        "time_lag", "lag_dates", "day_of_week_num", "day_of_week", "MeanTemp", "DewPoint"
    )
    assert rows(hit) == [
        (0, day("2020-06-10"), 4, "Wed", 20.0, 10.0), (45, day("2020-07-25"), 7, "Sat", 25.0, None),
    ]
    assert climate.count_covered_people(table).first()[0] == 2
    assert climate.count_unshifted_covered(people(spark), table).first()[0] == 1
    assert rows(climate.lag_grid(spark, 2)) == [(-1,), (-2,), (0,), (1,), (2,)]


def test_years_stack_by_name(spark):
    turned = weather(spark).select("Date", "POSTCODE", "DewPoint", "Precip", "MeanTemp")
    stacked = climate.stack_years(weather(spark), turned)
    assert stacked.count() == 8 and stacked.distinct().count() == 4


def test_zips_in_common_and_missing(spark):
    shared = climate.shared_zips(people(spark), weather(spark))
    assert rows(shared) == [("10035",)]
    kept = climate.climate_for_zips(weather(spark), shared, ordered=True)
    assert [r["Date"].month for r in kept.collect()] == [6, 7, 12]
    missing = climate.unmatched_zips(people(spark), weather(spark))
    assert rows(missing) == [(None, 1), ("99999", 2)]
    assert rows(climate.unmatched_zips(people(spark), weather(spark), start=2)) == [("99999", 2)]


def test_rows_are_numbered_as_by_one_sort(spark):
    zips = [None, "1", "10", "100", "1000", "10001", "10002", "2", "20001", "x"] + [
        f"{i:05d}" for i in range(30000, 30200, 3)
    ]
    df = spark.createDataFrame([(z,) for z in reversed(zips)], "zip_code string").repartition(5)
    numbered = {r["zip_code"]: r["row_num"] for r in climate.number_rows(df, "zip_code").collect()}
    in_order = sorted(zips, key=lambda z: (z is not None, z or ""))
    assert numbered == {z: i + 1 for i, z in enumerate(in_order)}


def test_area_attributes(spark):
    crosswalk = spark.createDataFrame(
        [("10035", "10035"), ("10029", "10035")], "ZIP_CODE string, ZCTA string"
    )
    attributes = spark.createDataFrame([("10035", "1.5", "n/a")], "ZCTA string, Asian string, male string")
    by_zip = area.zcta_attributes_by_zip(attributes, crosswalk)
    assert rows(by_zip, "zipcode") == [("10029",), ("10035",)]
    joined = area.cast_measures(area.attach_area_attributes(people(spark), by_zip), ["Asian", "male"])
    assert rows(joined, "person_id", "ZCTA", "Asian", "male") == [
        ("a", "10035", 1.5, None), ("b", None, None, None), ("c", None, None, None),
        ("d", "10035", 1.5, None),
    ]
    summary = spark.createDataFrame([("a", 3, "x")], "person_id string, MDs int, other string")
    assert rows(area.attach_disease_count(joined, summary), "person_id", "MDs")[0] == ("a", 3)
    placed = spark.createDataFrame(
        [("c", "s", "1", None), ("c", "s", "1", None), ("d", "s", "2", "9")],
        "city string, state string, zip string, ZCTA string",
    )
    assert rows(area.unmatched_areas(placed)) == [("c", "s", "1", None)]
    assert rows(area.count_by(people(spark), "zip_code")) == [(None, 1), ("10035", 2), ("99999", 1)]


def test_crosswalk_and_monitors(spark):
    base = spark.createDataFrame(
        [("10035", "n", "1"), ("10029", "n", "1")], "ZIP_CODE string, PO_NAME string, ZCTA string"
    )
    update = spark.createDataFrame(
        [("1", "n", "10035"), ("2", "n", "10001")], "ZCTA string, PO_NAME string, ZIP_CODE string"
    )
    assert area.zip_zcta_crosswalk(base, update).count() == 3
    assert area.zip_zcta_crosswalk(base, update, whole_rows=True).count() == 4
    zips = area.cohort_zips(people(spark))
    assert rows(zips) == [(None,), ("10035",), ("99999",)]
    assert rows(area.cohort_zips(people(spark), "d", distinct=False)) == [("10035",)]
    located = area.zips_to_zcta(zips, area.zip_zcta_crosswalk(base, update))
    assert rows(located) == [(None, None), ("10035", "1"), ("99999", None)]
    pairs = spark.createDataFrame(
        [("1", "m1", 10, 1), ("1", "m1", 10, 1), ("1", "m2", 20, 0), ("2", "m3", 5, 1)],
        "ZCTA string, Monitor_ID string, Distance_m int, WithinZCTA int",
    )
    monitors = area.zcta_monitors(pairs)
    assert monitors.columns == ["zcta", "aqs_site_id", "Distance_m", "WithinZCTA"]
    assert area.zcta_monitors(pairs, zcta="2").count() == 1
    assert area.nearby_monitors(located, monitors).count() == 2
    assert area.nearby_monitors(located, monitors, dedupe=False).count() == 3
    older = spark.createDataFrame([("1", "m1")], "zcta string, monitor string")
    assert area.zcta_monitors(older, zcta="1", older=True).columns == ["zcta", "aqs_site_id"]
    readings = spark.createDataFrame([("m1",), ("m1",), ("m3",)], "aqs_site_id string")
    nearby = area.nearby_monitors(located, monitors)
    assert rows(area.monitors_with_data(readings, nearby)) == [("m1",)]
