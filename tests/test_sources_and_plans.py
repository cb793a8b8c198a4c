import re

import pytest
from conftest import day, rows
from pyspark.errors import AnalysisException

from cohortair.operators import air, codes, cohort, conditions, joins, visits
from cohortair.plans import environment
from cohortair.settings import NO2, PM25, SO2
from cohortair.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_publish_and_read(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "person_id")
    stored = tables.publish(df, "people", str(tmp_path), cluster_by=("person_id",))
    assert rows(stored) == rows(df) == rows(tables.read_table(spark, "people", str(tmp_path)))
    # A stored table is never overwritten, least of all by rows that come from it.
    with pytest.raises(AnalysisException):
        tables.publish(stored.where("person_id > 5"), "people", str(tmp_path))
    assert rows(stored) == rows(df) == rows(tables.read_table(spark, "people", str(tmp_path)))
    assert tables.new_folder(spark) != tables.new_folder(spark)


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = tables.publish_table(
        spark.range(100).withColumnRenamed("id", "person_id"), "bucketed_left", "person_id", 4
    )
    right = tables.publish_table(
        spark.range(50).selectExpr("id AS person_id", "id AS v"), "bucketed_right", "person_id", 4
    )
    joined = left.join(right.hint("merge"), "person_id")
    assert joined.count() == 50
    assert "Exchange" not in plan_of(joined)
    assert rows(tables.read_table(spark, "bucketed_right")) == rows(right)
    assert tables.publish_table(right, "plain_copy").count() == 50
    # Never overwritten, least of all by rows that come from it.
    with pytest.raises(AnalysisException):
        tables.publish_table(right.where("person_id > 5"), "bucketed_right", "person_id", 4)
    assert rows(tables.read_table(spark, "bucketed_right")) == rows(right)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    written = spark.range(5).selectExpr(
        "id AS aqs_site_id", "date'2020-01-01' AS DateLocal", "1.0D AS ArithmeticMean",
        "'u' AS UnitsofMeasure", "'1 HOUR' AS SampleDuration", "24 AS ObservationCount",
        "42602 AS ParameterCode", "'n' AS ParameterName", "'c' AS CityName", "'s' AS StateName",
        "0.0D AS Latitude", "0.0D AS Longitude", "'never read' AS other",
    )
    table = tables.publish(written, "readings", str(tmp_path))
    of_kind = air.pollutant(table, NO2.code, NO2.keep)
    plan = plan_of(air.daily_series(of_kind, NO2))
    assert "EqualTo(ParameterCode,42602)" in plan and "EqualTo(SampleDuration,1 HOUR)" in plan
    assert "IsNotNull(ObservationCount)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "CityName" not in schema and "other" not in schema and "ParameterName" not in schema


def test_code_lists_are_broadcast_only_when_small(spark):
    listed = spark.createDataFrame([("pcr", 1), ("pcr", 2)], "concept_set_name string, concept_id int")
    assert joins.measured_bytes(listed) == 2 * (3 + 16 + 16)
    assert joins.measured_bytes(listed.where("concept_id > 5")) == 0
    facts = spark.createDataFrame([(1,), (3,)], "measurement_concept_id int")
    assert "BroadcastHashJoin" in plan_of(codes.tag_facts(facts, listed, "measurement_concept_id"))
    assert joins.broadcast_if_small(listed, max_bytes=10) is listed


def test_missing_keys_are_spread_and_match_nothing(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).selectExpr("id", "CASE WHEN id < 10 THEN id % 3 END AS k")
        right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "x")], "k long, v string")
        joined = joins.attach(left, right, "k")
        assert re.search(r"hashpartitioning\(k#\d+L?, _spread", plan_of(joined))
        assert rows(joined.groupBy("v").count()) == [(None, 993), ("a", 4), ("b", 3), ("c", 3)]
        assert joined.columns == ["k", "id", "v"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored_visits(spark, folder):
    rows_ = [(f"p{i % 7}", f"s{i % 11}", day("2020-01-01"), day("2020-01-09"), i) for i in range(60)]
    made = spark.createDataFrame(
        rows_,
        "person_id string, macrovisit_id string, macrovisit_start_date date, "
        "macrovisit_end_date date, visit_occurrence_id int",
    )
    return tables.publish(made, "visits", folder)


def exchanges_over(plan, file):
    """Shuffles between a file's scan and the top, the broadcasts' own not counted."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and file in line)
    depth, found = len(lines[at]), 0
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if indent < depth:
            depth = indent
            found += "Exchange hashpartitioning" in line
    return found


def test_visits_are_shuffled_once_before_the_last_grouping(spark, tmp_path):
    table = stored_visits(spark, str(tmp_path))
    cohort_ = spark.createDataFrame(
        [("p1", day("2020-01-01"), day("2020-01-01"), day("2020-01-02"), day("2020-01-03"))],
        "person_id string, first_pos_pcr_antigen_date date, first_poslab_or_diagnosis_date date, "
        "first_COVID_hospitalization_start_date date, first_COVID_hospitalization_end_date date",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for small in (False, True):
            stays = visits.associated_stays(table, cohort_, small_people=small)
            first = visits.first_covid_stay(cohort_, table, small_people=small)
            later = visits.later_stays(cohort_, table, small_people=small)
            # By (person, start) and then by person; the later stays by person alone.
            assert exchanges_over(plan_of(stays), "visits") == 2
            assert exchanges_over(plan_of(first), "visits") == 2
            assert exchanges_over(plan_of(later), "visits") == 1
        assert rows(visits.associated_stays(table, cohort_, small_people=True)) == rows(
            visits.associated_stays(table, cohort_, small_people=False)
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_condition_records_are_shuffled_once(spark, tmp_path):
    made = spark.createDataFrame(
        [("p1", day("2020-01-01"), 1, 5)],
        "person_id string, condition_start_date date, condition_concept_id int, condition_occurrence_id int",
    )
    facts = tables.publish(made, "facts", str(tmp_path))
    codes_ = spark.createDataFrame([(1, "asthma")], "concept_id int, column_name string")
    ids = spark.createDataFrame([("p1",)], "person_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for small in (True, False):
            flags = conditions.condition_flags_by_date(ids, facts, codes_, small_people=small)
            assert exchanges_over(plan_of(flags), "facts") == 1
            assert rows(flags) == [("p1", day("2020-01-01"), 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", [NO2, SO2, PM25], ids=lambda k: k.name)
def test_series_scan_the_readings_once(spark, tmp_path, kind):
    written = spark.range(5).selectExpr(
        "cast(id AS string) AS aqs_site_id", "date'2020-01-01' AS DateLocal", "1.0D AS ArithmeticMean",
        "'u' AS UnitsofMeasure", "'1 HOUR' AS SampleDuration", "24 AS ObservationCount",
        f"{kind.code} AS ParameterCode", "'n' AS ParameterName", "'c' AS CityName", "'s' AS StateName",
        "0.0D AS Latitude", "0.0D AS Longitude",
    )
    table = tables.publish(written, "all_readings", str(tmp_path))
    people = spark.createDataFrame([("p", "10035")], "person_id string, zip_code string")
    crosswalk = spark.createDataFrame([("10035", "1")], "ZIP_CODE string, ZCTA string")
    pairs = spark.createDataFrame(
        [("1", "3", 1, 1)], "ZCTA string, Monitor_ID string, Distance_m int, WithinZCTA int"
    )
    series = environment.pollutant_series(table, people, crosswalk, pairs, kind)
    plan = plan_of(series)
    assert len(re.findall(r"FileScan.*all_readings", plan)) == 1
    assert f"EqualTo(ParameterCode,{kind.code})" in plan
    assert [r["ParameterName"] for r in series.collect()] == ["n"]


def test_days_are_never_broadcast(spark):
    people = spark.createDataFrame([("a", day("2020-01-01"))], "person_id string, first_pos_pcr_antigen_date date")
    stays = spark.createDataFrame(
        [("a", "s", day("2020-01-01"), day("2020-01-02"))],
        "person_id string, macrovisit_id string, macrovisit_start_date date, macrovisit_end_date date",
    )
    plan = plan_of(visits.first_covid_stay(people, stays))
    joined = re.search(r"(\w+)Join \[person_id#\d+, macrovisit_start_date", plan)
    assert joined.group(1) == "SortMerge"


def test_first_events_are_one_grouping(spark):
    labs = spark.createDataFrame([], "person_id string, measurement_date date, concept_set_name string")
    diagnoses = spark.createDataFrame(
        [], "person_id string, condition_start_date date, concept_set_name string"
    )
    from cohortair.settings import CodeSetNames

    names = CodeSetNames(antibody="a", diagnosis="d")
    plan = plan_of(cohort.first_event_dates(labs, diagnoses, names, poslab_only=False))
    assert plan.count("Exchange hashpartitioning") <= 1 and "Join" not in plan


class FakeSession:
    """A session as far as the shared folder goes."""

    def __init__(self, master, setting=None):
        self.conf = type("Conf", (), {"get": lambda _, key, default: setting})()
        self.sparkContext = type(
            "Context", (), {"master": master, "getCheckpointDir": lambda _: None}
        )()


def test_shared_folder_is_the_clusters_setting():
    assert tables.shared_folder(FakeSession("yarn", "s3://bucket/folder/")) == "s3://bucket/folder"
    with pytest.raises(ValueError):
        tables.shared_folder(FakeSession("yarn"))


def test_local_session_gets_a_folder_once(spark):
    assert tables.shared_folder(spark) == tables.shared_folder(spark)
