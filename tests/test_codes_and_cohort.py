from conftest import day, rows

from cohortair.operators import codes, cohort
from cohortair.settings import CodeSetNames

NAMES = CodeSetNames(
    antibody="antibody", diagnosis="diagnosis", pcr_antigen="pcr", positive_result="positive"
)
MEMBERS = "concept_set_name string, concept_id int, is_most_recent_version string, version int"


def members(spark):
    return spark.createDataFrame(
        [
            ("pcr", 1, "true", 2),
            ("pcr", 1, "false", 1),
            ("pcr", 2, "true", None),
            ("antibody", 1, "true", 1),
            ("antibody", 3, "true", 1),
            ("positive", 9, "true", 1),
        ],
        MEMBERS,
    )


def test_code_set_takes_newest_released_version(spark):
    assert rows(codes.code_set(members(spark), "pcr"), "concept_id", "version") == [(1, 2)]


def test_code_in_two_sets_stays_twice_and_multiplies_facts(spark):
    tests = codes.union_code_sets(
        codes.code_set(members(spark), "pcr"), codes.code_set(members(spark), "antibody")
    )
    facts = spark.createDataFrame(
        [("a", 1, 9), ("b", 3, 9), ("c", 3, 8), ("d", 4, 9)],
        "person_id string, measurement_concept_id int, value_as_concept_id int",
    )
    tagged = codes.tag_facts(facts, tests, "measurement_concept_id")
    assert rows(tagged, "person_id", "concept_set_name") == [
        ("a", "antibody"), ("a", "pcr"), ("b", "antibody"), ("c", "antibody"),
    ]
    positive = codes.positive_results(tagged, codes.code_set(members(spark), "positive"))
    assert positive.columns == tagged.columns
    assert rows(positive, "person_id", "concept_set_name") == [
        ("a", "antibody"), ("a", "pcr"), ("b", "antibody"),
    ]


def labs(spark, data):
    return spark.createDataFrame(
        [(p, day(d), s) for p, d, s in data],
        "person_id string, measurement_date date, concept_set_name string",
    )


def diagnoses(spark, data):
    return spark.createDataFrame(
        [(p, day(d), s) for p, d, s in data],
        "person_id string, condition_start_date date, concept_set_name string",
    )


def test_first_events_and_the_kind_that_came_first(spark):
    tests = labs(
        spark,
        [
            ("tie", "2020-05-01", "pcr"), ("tie", "2020-05-01", "antibody"),
            ("tie", "2020-06-01", "pcr"),
            ("anti", "2020-05-02", "antibody"), ("anti", "2020-05-03", "something else"),
            ("diag", "2020-05-09", "pcr"), ("none", None, "pcr"),
        ],
    )
    found = diagnoses(
        spark,
        [
            ("tie", "2020-05-01", "diagnosis"), ("diag", "2020-05-04", "diagnosis"),
            ("anti", "2020-05-05", "other"), ("only other", "2020-05-05", "other"),
        ],
    )
    everyone = cohort.first_event_dates(tests, found, NAMES, poslab_only=False)
    by_person = {r["person_id"]: r for r in everyone.collect()}
    assert set(by_person) == {"tie", "anti", "diag", "none"}
    assert by_person["tie"]["covid_event_type"] == "PCR or Antigen Test"
    assert by_person["tie"]["first_pos_pcr_antigen_date"] == day("2020-05-01")
    assert by_person["diag"]["covid_event_type"] == "Condition Diagnosis"
    assert by_person["diag"]["first_poslab_or_diagnosis_date"] == day("2020-05-04")
    assert by_person["anti"]["covid_event_type"] == "Antibody Test"
    assert by_person["anti"]["first_poslab_or_diagnosis_date"] is None
    assert by_person["anti"]["first_antigen_or_poslab_or_diagnosis_date"] == day("2020-05-02")
    assert by_person["none"]["covid_event_type"] is None
    assert rows(cohort.first_event_dates(tests, found, NAMES)) == [
        ("diag", day("2020-05-09")), ("tie", day("2020-05-01")),
    ]


def test_positive_dates_and_gaps(spark):
    tests = labs(
        spark,
        [("a", "2020-05-01", "pcr"), ("a", "2020-05-01", "pcr"), ("a", "2020-05-11", "pcr"),
         ("a", "2020-05-05", "antibody"), ("b", "2020-01-31", "pcr")],
    )
    found = diagnoses(spark, [("a", "2020-05-11", "diagnosis"), ("a", "2020-05-20", "other")])
    lab_only = cohort.positive_dates(tests, found, NAMES)
    assert rows(cohort.days_since_previous(lab_only)) == [
        ("a", day("2020-05-01"), None), ("a", day("2020-05-11"), 10), ("b", day("2020-01-31"), None),
    ]
    both = cohort.positive_dates(tests, found, NAMES, poslab_only=False)
    assert rows(both, "person_id", "covid_date", "covid_event_type") == [
        ("a", day("2020-05-01"), "PCR or Antigen Test"),
        ("a", day("2020-05-11"), "Condition Diagnosis"),
        ("a", day("2020-05-11"), "PCR or Antigen Test"),
        ("a", day("2020-05-20"), "Other Condition"),
        ("b", day("2020-01-31"), "PCR or Antigen Test"),
    ]
    # Two events on one day are one date, not a gap of zero days.
    assert rows(cohort.days_since_previous(both), "covid_date", "days_since_pos_pcr_antigen") == [
        (day("2020-01-31"), None), (day("2020-05-01"), None), (day("2020-05-11"), 10),
        (day("2020-05-20"), 9),
    ]
    in_order = cohort.positive_dates(tests, found, NAMES, ordered=True).collect()
    assert [(r["person_id"], r["covid_date"]) for r in in_order] == [
        ("a", day("2020-05-01")), ("a", day("2020-05-11")), ("b", day("2020-01-31")),
    ]


def test_attach_people_keeps_people_without_a_location(spark):
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "person_id string")
    person = spark.createDataFrame(
        [("a", 1, 7), ("b", None, 7)], "person_id string, location_id int, data_partner_id int"
    )
    location = spark.createDataFrame(
        [(1, "x", 5)], "location_id int, city string, data_partner_id int"
    )
    joined = cohort.attach_people(found, person, location)
    assert rows(joined, "person_id", "city", "data_partner_id") == [
        ("a", "x", 7), ("b", None, 7), ("c", None, None),
    ]
