import pytest
from conftest import day, rows

from cohortair.functions.demographics import RACE_RULES_OLDER
from cohortair.operators import conditions, people


def test_birth_date_and_age(spark):
    data = [
        ("full", 1950, 3, 9, "2020-03-08"),
        ("birthday", 1950, 3, 9, "2020-03-09"),
        ("no year", None, 3, 9, "2020-01-01"),
        ("no month", 1950, None, 9, "2020-01-01"),
        ("no day", 1950, 3, None, "2020-01-01"),
        ("no such day", 1950, 2, 30, "2020-01-01"),
        ("unborn", 2021, 1, 1, "2020-01-01"),
        ("leap 28", 2000, 2, 29, "2020-02-28"),
        ("leap 29", 2000, 2, 29, "2020-02-29"),
        ("leap last", 2000, 2, 29, "2021-02-28"),
        ("no index", 1950, 1, 1, None),
    ]
    df = spark.createDataFrame(
        [(*d[:4], day(d[4])) for d in data],
        "person_id string, year_of_birth int, month_of_birth int, day_of_birth int, "
        "first_pos_pcr_antigen_date date",
    )
    aged = people.birth_and_age(df)
    found = {r["person_id"]: (r["date_of_birth"], r["age_at_first_covid_diag"]) for r in aged.collect()}
    assert found == {
        "full": (day("1950-03-09"), 69),
        "birthday": (day("1950-03-09"), 70),
        "no year": (None, None),
        "no month": (day("1950-01-09"), 69),
        "no day": (day("1950-03-01"), 69),
        "no such day": (None, None),
        "unborn": (day("2021-01-01"), None),
        "leap 28": (day("2000-02-29"), 19),
        "leap 29": (day("2000-02-29"), 20),
        "leap last": (day("2000-02-29"), 21),
        "no index": (day("1950-01-01"), None),
    }
    kept = people.birth_and_age(df, keep_negative=True).where("person_id = 'unborn'")
    assert kept.first()["age_at_first_covid_diag"] == -1


def test_gender_in_any_case(spark):
    df = spark.createDataFrame(
        [("Male",), ("FEMALE",), ("female",), ("OTHER",), (None,)], "gender_concept_name string"
    )
    assert [r["gender"] for r in people.standard_gender(df).collect()] == [
        "MALE", "FEMALE", "FEMALE", "UNKNOWN", "UNKNOWN",
    ]


def test_race_rules_in_order(spark):
    cases = [
        ("Hispanic or Latino", None, "Hispanic or Latino Any Race", "Hispanic or Latino Any Race"),
        ("Hispanic or Latino", "White", "Hispanic or Latino Any Race", "Hispanic or Latino Any Race"),
        (None, "White or Hispanic", "Hispanic or Latino Any Race", "Hispanic or Latino Any Race"),
        (None, "African American", "Black or African American Non-Hispanic",
         "Black or African American Non-Hispanic"),
        (None, "African", "UNKNOWN", "UNKNOWN"),
        (None, "white", "UNKNOWN", "UNKNOWN"),
        (None, "Asian or Pacific Islander", "Unknown", "Unknown"),
        (None, "Asian Indian", "Asian Indian", "Asian Non-Hispanic"),
        (None, "Sri Lankan", "Asian Non-Hispanic", "Asian Non-Hispanic"),
        (None, "Other Pacific Islander", "Native Hawaiian or Other Pacific Islander Non-Hispanic",
         "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
        (None, "Other Race", "UNKNOWN", "Other Non-Hispanic"),
        (None, "More than one race", "UNKNOWN", "Other Non-Hispanic"),
        (None, None, "UNKNOWN", "UNKNOWN"),
    ]
    df = spark.createDataFrame(
        [c[:2] for c in cases], "ethnicity_concept_name string, race_concept_name string"
    )
    assert [r["race_ethnicity"] for r in people.race_ethnicity(df).collect()] == [c[2] for c in cases]
    older = people.race_ethnicity(df, RACE_RULES_OLDER)
    assert [r["race_ethnicity"] for r in older.collect()] == [c[3] for c in cases]


def test_clean_zip(spark):
    raw = ["  10035", "10035-1234", "1003", "1003A", "A10035", "", None, " 100356 "]
    df = spark.createDataFrame([(z,) for z in raw], "zip string")
    assert [r["zip_code"] for r in people.clean_zip(df).collect()] == [
        "10035", "10035", None, None, None, None, None, "10035",
    ]


def test_last_death_is_one_row_per_person(spark):
    ids = spark.createDataFrame([("two",), ("null",), ("mixed",), ("none",)], "person_id string")
    death = spark.createDataFrame(
        [("two", day("2020-01-01"), 1), ("two", day("2020-02-01"), 2), ("null", None, 1),
         ("mixed", None, 1), ("mixed", day("2020-03-01"), 1), ("stranger", day("2020-01-01"), 1)],
        "person_id string, death_date date, data_partner_id int",
    )
    assert rows(people.last_death(ids, death)) == [
        ("mixed", day("2020-03-01"), 1), ("none", None, 0), ("null", None, 0),
        ("two", day("2020-02-01"), 1),
    ]
    assert people.last_death(ids, death, latest_only=False).count() == 6


def test_sample_is_all_rows_or_the_same_people(spark):
    ids = spark.range(2000).selectExpr("cast(id as string) AS person_id")
    assert people.sample_cohort(ids).count() == 2000
    drawn = rows(people.sample_cohort(ids, 0.25, stable_key="person_id"))
    assert drawn == rows(people.sample_cohort(ids.repartition(7), 0.25, stable_key="person_id"))
    assert 400 < len(drawn) < 600
    assert 350 < people.sample_cohort(ids, 0.25).count() < 650


def test_locations_and_sites(spark):
    found = spark.createDataFrame(
        [("a", day("2020-01-01"), day("2020-01-01")), ("b", None, day("2020-01-01"))],
        "person_id string, first_poslab_or_diagnosis_date date, "
        "first_antigen_or_poslab_or_diagnosis_date date",
    )
    person = spark.createDataFrame(
        [("a", 1950, 1, 1, "e", "r", "g", 1, 3), ("b", 1960, 1, 1, "e", "r", "g", None, None)],
        "person_id string, year_of_birth int, month_of_birth int, day_of_birth int, "
        "ethnicity_concept_name string, race_concept_name string, gender_concept_name string, "
        "location_id int, data_partner_id int",
    )
    location = spark.createDataFrame(
        [(1, "c", "s", "10035", "co", 9)],
        "location_id int, city string, state string, zip string, county string, data_partner_id int",
    )
    manifest = spark.createDataFrame(
        [(3, day("2022-01-01"), "m", "5", "N", 0)],
        "data_partner_id int, run_date date, cdm_name string, cdm_version string, "
        "shift_date_yn string, max_num_shift_days int",
    )
    located = people.attach_locations(found, person, location, manifest)
    assert rows(located, "person_id", "data_partner_id", "zip", "shift_date_yn") == [
        ("a", 3, "10035", "N"), ("b", None, None, None),
    ]
    older = people.attach_locations(found, person, location, manifest, drop_without_index=True)
    assert rows(older, "person_id") == [("a",)]
    assert "first_antigen_or_poslab_or_diagnosis_date" not in older.columns


def test_a_sample_holds_the_same_people_in_every_use(spark):
    cohort = spark.range(20000).selectExpr("cast(id AS string) AS person_id", "id % 7 AS k")
    drawn = people.sample_cohort(cohort.groupBy("person_id").count(), 0.3)
    again = people.sample_cohort(cohort.repartition(7, "k"), 0.3)
    first = {r.person_id for r in drawn.collect()}
    assert first == {r.person_id for r in drawn.repartition(3).collect()}
    assert first == {r.person_id for r in again.collect()}
    assert 5500 < len(first) < 6500


def test_conditions(spark):
    rules = spark.createDataFrame(
        [("set a", "asthma", "condition_occurrence, drug", 1, 0),
         ("set b", "cancer", "condition_occurrence", 1, 0),
         ("set c", "skipped", "condition_occurrence", 0, 0), ("set d", "drug", "drug", 1, 1)],
        "concept_set_name string, column_name string, domain string, comorbidity int, "
        "er_only_visit int",
    )
    members = spark.createDataFrame(
        [("set a", 1, "true"), ("set a", 2, "false"), ("set b", 3, "true"), ("set c", 4, "true"),
         ("set d", 5, "true")],
        "concept_set_name string, concept_id int, is_most_recent_version string",
    )
    codes = conditions.condition_codes(rules, members)
    assert rows(codes) == [(1, "asthma"), (3, "cancer")]
    facts = spark.createDataFrame(
        [("p", day("2020-02-01"), 1, 12), ("p", day("2020-02-01"), 1, 11), ("p", None, 1, 1),
         ("p", day("2020-03-01"), 1, 2), ("p", day("2020-03-01"), 3, 30),
         ("q", day("2020-03-01"), 4, 40), ("stranger", day("2020-01-01"), 1, 50)],
        "person_id string, condition_start_date date, condition_concept_id int, "
        "condition_occurrence_id int",
    )
    ids = spark.createDataFrame([("p", 1), ("q", 2)], "person_id string, fact int")
    names = ["asthma", "cancer"]
    assert rows(conditions.first_conditions_wide(ids, facts, codes, names)) == [
        ("p", day("2020-02-01"), 11, day("2020-03-01"), 30)
    ]
    assert conditions.condition_names(rules) == names
    assert rows(conditions.first_conditions_wide(ids, facts, codes)) == [
        ("p", day("2020-02-01"), 11, day("2020-03-01"), 30)
    ]
    for operator in (conditions.first_conditions_wide, conditions.condition_flags_by_date):
        with pytest.raises(ValueError, match="cancer"):
            operator(ids, facts, codes, ["asthma"])
    assert rows(conditions.condition_flags_by_date(ids, facts, codes)) == rows(
        conditions.condition_flags_by_date(ids, facts, codes, names, small_people=False)
    )
    flags = conditions.condition_flags_by_date(ids, facts, codes, names)
    assert rows(flags) == [("p", day("2020-02-01"), 1, 0), ("p", day("2020-03-01"), 1, 1)]
    assert rows(conditions.condition_flags_by_person(flags, ids, names)) == [
        ("p", 1, 1, 1), ("q", 2, 0, 0),
    ]
