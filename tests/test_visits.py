import datetime

import pytest
from conftest import day, rows

from cohortair.operators import checks, visits

VISIT = (
    "person_id string, data_partner_id int, visit_occurrence_id int, visit_concept_id int, "
    "visit_concept_name string, visit_start_date date, visit_end_date date, macrovisit_id string, "
    "macrovisit_start_date date, macrovisit_end_date date"
)


def visit_table(spark, data):
    """Visits from (person, code, visit start, stay id, stay start, stay end)."""
    return spark.createDataFrame(
        [
            (p, 1, i, code, "name", day(start), day(start), stay, day(first), day(last))
            for i, (p, code, start, stay, first, last) in enumerate(data)
        ],
        VISIT,
    )


def stay(person, stay_id, start, end):
    return (person, 9201, start, stay_id, start, end)


def patients(spark, data):
    return spark.createDataFrame(
        [(p, day(lab), day(diag), day(first)) for p, lab, diag, first in data],
        "person_id string, first_pos_pcr_antigen_date date, first_pos_diagnosis_date date, "
        "first_poslab_or_diagnosis_date date",
    )


@pytest.mark.parametrize(
    "start, end, flagged",
    [
        ("2020-06-08", "2020-06-30", 0),
        ("2020-06-09", "2020-06-30", 1),
        ("2020-06-26", "2020-06-30", 1),
        ("2020-06-27", "2020-06-30", 0),
        ("2020-06-09", "2020-06-09", 0),
        ("2020-06-10", None, 0),
    ],
)
def test_stay_window_around_june_10(spark, start, end, flagged):
    table = visit_table(spark, [stay("a", "s", start, end)])
    people = patients(spark, [("a", "2020-06-10", None, None)])
    found = visits.first_covid_stay(people, table).first()
    assert found["covid_associated_hosp"] == flagged
    assert found["first_covid_macrovisit_id"] == ("s" if flagged else None)
    dates = spark.createDataFrame([("a", day("2020-06-10"))], "person_id string, covid_date date")
    kept = visits.flag_stays(visits.cohort_stays(table), dates).first()
    assert kept["covid_associated_hosp"] == flagged
    assert kept["poslab_date"] == (day("2020-06-10") if flagged else None)


def test_first_stay_breaks_ties_by_id_and_keeps_everyone(spark):
    table = visit_table(
        spark,
        [stay("a", "s2", "2020-06-11", "2020-06-20"), stay("a", "s1", "2020-06-11", "2020-06-12"),
         stay("a", "s1", "2020-06-11", "2020-06-12"), stay("a", "s0", "2020-06-12", "2020-06-13"),
         ("a", 1, "2020-06-10", None, None, None)],
    )
    people = patients(spark, [("a", "2020-06-10", None, None), ("b", "2020-06-10", None, None)])
    found = visits.first_covid_stay(people, table)
    assert rows(
        found, "person_id", "first_covid_macrovisit_id", "first_covid_macrovisit_end_date",
        "covid_associated_hosp",
    ) == [("a", "s1", day("2020-06-12"), 1), ("b", None, None, 0)]


def test_flagged_stays_match_brute_force(spark):
    base = datetime.date(2020, 1, 1)
    stays, dates = [], []
    for i in range(120):
        person = f"p{i % 3}"
        start = base + datetime.timedelta(days=(i * 37) % 150)
        stays.append((person, f"s{i}", start, start + datetime.timedelta(days=i % 6)))
        dates.append((person, base + datetime.timedelta(days=(i * 53) % 160)))
    table = spark.createDataFrame(
        [(p, 1, s, b, e) for p, s, b, e in stays],
        "person_id string, data_partner_id int, macrovisit_id string, macrovisit_start_date date, "
        "macrovisit_end_date date",
    )
    found = visits.flag_stays(
        table, spark.createDataFrame(dates, "person_id string, covid_date date")
    )
    expected = {}
    for p, s, b, e in stays:
        near = [d for q, d in dates if q == p and -1 <= (b - d).days <= 16 and d <= e]
        expected[s] = min(near) if near else None
    assert {r["macrovisit_id"]: r["poslab_date"] for r in found.collect()} == expected
    assert found.count() == len(stays)


def test_cohort_visits_split(spark):
    table = visit_table(
        spark,
        [stay("a", "s", "2020-06-11", "2020-06-20"), stay("a", "s", "2020-06-11", "2020-06-20"),
         ("a", 5, "2020-01-01", None, None, None), stay("x", "t", "2020-06-11", "2020-06-20")],
    )
    dates = spark.createDataFrame(
        [("a", day("2020-06-10"), "PCR or Antigen Test"), ("a", day("2020-06-12"), "Other")],
        "person_id string, covid_date date, covid_event_type string",
    )
    assert visits.positive_lab_dates(dates).count() == 1
    mine = visits.cohort_visits(table, dates)
    assert mine.count() == 3
    assert rows(visits.cohort_stays(mine), "person_id", "macrovisit_id") == [("a", "s")]
    other = visits.cohort_other_visits(mine)
    assert rows(other, "person_id", "visit_concept_id") == [("a", 5)]
    assert not [c for c in other.columns if c.startswith("macrovisit")]


def test_er_visits_and_stays_by_mode(spark):
    table = visit_table(
        spark,
        [("a", 7, "2020-06-08", None, None, None), ("a", 7, "2020-06-09", None, None, None),
         ("a", 8, "2020-06-10", None, None, None), ("a", 7, "2020-06-10", "s", "2020-06-10", None),
         ("b", 7, "2020-06-26", None, None, None), ("b", 7, "2020-06-27", None, None, None),
         stay("b", "z", "2020-06-20", "2020-06-21"), stay("b", "y", "2020-06-20", "2020-06-25")],
    )
    people = patients(
        spark,
        [("a", "2020-06-10", None, "2020-06-10"), ("b", "2020-06-12", "2020-06-10", "2020-06-10"),
         ("c", None, None, None)],
    )
    codes = spark.createDataFrame([(7,), (7,)], "concept_id int")
    assert rows(visits.associated_er_visits(table, people, codes)) == [
        ("a", day("2020-06-09")), ("b", day("2020-06-26")),
    ]
    # The lab date counts, and only where a diagnosis is near to it.
    assert rows(visits.associated_er_visits(table, people, codes, mode="both")) == []
    assert rows(
        visits.associated_er_visits(table, people, codes, before=2, after=16, mode="both")
    ) == [("b", day("2020-06-26"))]
    first = visits.associated_stays(table, people)
    assert rows(first, "person_id", "macrovisit_id") == [("a", "s"), ("b", "y")]
    er = visits.associated_er_visits(table, people, codes)
    merged = visits.merge_first_visits(people, first, er)
    assert merged.count() == 3 and "first_covid_er_only_start_date" in merged.columns
    assert "first_covid_er_only_start_date" not in visits.merge_first_visits(people, first).columns
    later = visits.later_stays(merged, table)
    assert rows(later, "person_id", "macrovisit_id") == []
    with pytest.raises(ValueError):
        visits.associated_stays(table, people, mode="neither")


def test_later_stays_start_after_the_stay_or_the_index(spark):
    table = visit_table(
        spark,
        [stay("a", "s1", "2020-06-11", "2020-06-12"), stay("a", "s2", "2020-07-01", "2020-07-02"),
         stay("a", "s2", "2020-07-03", "2020-07-04"), stay("b", "t1", "2020-05-01", "2020-05-02"),
         stay("b", "t2", "2020-06-10", "2020-06-12"), stay("b", "t3", "2020-06-11", "2020-06-12")],
    )
    merged = spark.createDataFrame(
        [("a", day("2020-06-10"), day("2020-06-11"), day("2020-06-12")),
         ("b", day("2020-06-10"), None, None)],
        "person_id string, first_poslab_or_diagnosis_date date, "
        "first_COVID_hospitalization_start_date date, first_COVID_hospitalization_end_date date",
    )
    assert rows(
        visits.later_stays(merged, table), "person_id", "macrovisit_id", "macrovisit_start_date"
    ) == [("a", "s2", day("2020-07-01")), ("b", "t3", day("2020-06-11"))]


def test_er_codes_are_newest_members_of_marked_sets(spark):
    rules = spark.createDataFrame([("er", 1), ("other", 0)], "concept_set_name string, er_only_visit int")
    members = spark.createDataFrame(
        [("er", 1, "true"), ("er", 2, "false"), ("other", 3, "true")],
        "concept_set_name string, concept_id int, is_most_recent_version string",
    )
    assert rows(visits.er_codes(rules, members)) == [(1,)]


def test_looking_at_stays(spark):
    table = visit_table(
        spark,
        [stay("a", "s", "2020-06-11", "2020-06-12"), ("a", 5, "2020-06-11", "s", "2020-06-11", None),
         stay("a", "t", "2020-05-11", "2020-05-12"), ("a", 9201, "2020-01-01", None, None, None)],
    )
    assert rows(checks.stay_code_counts(table)) == [("s", 1), ("t", 1)]
    assert [r["visit_concept_id"] for r in checks.stay_detail(table, "s").collect()] == [5, 9201]
    assert [r["macrovisit_id"] for r in checks.person_stays(table, "a").collect()] == ["t", "s", "s"]


def test_lines_of_no_stay_are_spread_over_tasks(spark, tmp_path):
    """Lines of no stay have a null id: they must not all meet in one task of the join with the stays."""
    from workload.standins import Study

    lines = [(o, n, 5, "R", datetime.date(2020, 1, n), "F" if o == 1 else "O") for o in (1, 2, 3) for n in (1, 2)]
    names = ("l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_shipdate date, l_linestatus string")
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, o * 10, "1-URGENT") for o in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    made = Study(spark, str(tmp_path)).visits()
    assert made.columns[:2] == ["macrovisit_id", "person_id"]
    got = sorted((r.visit_occurrence_id, r.macrovisit_id, r.macrovisit_end_date) for r in made.collect())
    end = datetime.date(2020, 1, 2)
    assert got == [(11, 1, end), (12, 1, end), (21, None, None), (22, None, None), (31, None, None), (32, None, None)]
    assert "_spread" in made._jdf.queryExecution().optimizedPlan().toString()
