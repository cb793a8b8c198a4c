"""From code lists and events to the base cohort, person facts and visits.

People, stays, deaths and scores are joined by person. Adaptive execution splits
a person with very many rows there; `sources.session.tune` turns that on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.functions.demographics import RACE_RULES, RACE_RULES_OLDER
from cohortair.operators import area, codes, conditions, people, visits
from cohortair.operators.joins import fits_broadcast
from cohortair.settings import LAB_INDEX, LAB_OR_DIAGNOSIS_INDEX, CodeSetNames


def tagged_events(
    members: DataFrame, measurement: DataFrame, condition: DataFrame, names: CodeSetNames
) -> tuple[DataFrame, DataFrame]:
    """Positive labs and diagnoses, each with the name of the set that coded it.

    The four code sets are measured together, in one pass over the lists.
    """
    pcr, antibody, positive, diagnosis = (
        codes.code_set(members, name)
        for name in (names.pcr_antigen, names.antibody, names.positive_result, names.diagnosis)
    )
    of_all = members.where(
        F.col("concept_set_name").isin(
            names.pcr_antigen, names.antibody, names.positive_result, names.diagnosis
        )
    )
    small = fits_broadcast(of_all.select("concept_set_name", "concept_id"))
    tests = codes.union_code_sets(pcr, antibody)
    labs = codes.positive_results(
        codes.tag_facts(measurement, tests, "measurement_concept_id", small), positive, small=small
    )
    return labs, codes.tag_facts(condition, diagnosis, "condition_concept_id", small)


def clean_people(located: DataFrame, older: bool = False) -> DataFrame:
    """Birth date, age, gender, race and ZIP in one form."""
    index_date = LAB_OR_DIAGNOSIS_INDEX if older else LAB_INDEX
    aged = people.birth_and_age(located, index_date, keep_negative=older)
    labelled = people.race_ethnicity(
        people.standard_gender(aged), RACE_RULES_OLDER if older else RACE_RULES
    )
    return people.clean_zip(labelled)


def person_fact(
    patients: DataFrame,
    person: DataFrame,
    location: DataFrame,
    manifest: DataFrame,
    visit: DataFrame,
    death: DataFrame,
    fraction: float = 1.0,
) -> DataFrame:
    """One row per cohort person: place, facts, first stay and death.

    Stay and death are found for the narrow cohort, before the wide columns
    are joined: all joins by person then share one shuffle of the cohort.
    """
    sampled = people.sample_cohort(patients, fraction)
    followed = people.last_death(visits.first_covid_stay(sampled, visit), death)
    return clean_people(people.attach_locations(followed, person, location, manifest))


def person_fact_older(
    patients: DataFrame,
    person: DataFrame,
    location: DataFrame,
    manifest: DataFrame,
    visit: DataFrame,
    death: DataFrame,
    condition: DataFrame,
    members: DataFrame,
    rules: DataFrame,
    names: Sequence[str] | None = None,
    mode: str = "either",
    include_er: bool = True,
    fraction: float = 1.0,
) -> DataFrame:
    """The older person table: condition flags, first stay and emergency visit.

    Conditions are those of the rule sheet unless names are given. Code lists
    and ids are measured once: the lists by the newest members they are cut
    from. The cohort is used five times, so callers should publish it.
    """
    sampled = people.sample_cohort(patients, fraction)
    newest = conditions.newest_members(members)
    small = fits_broadcast(newest)
    small_people = fits_broadcast(sampled.select("person_id"))
    if names is None:
        names = conditions.condition_names(rules)
    flags = conditions.condition_flags_by_date(
        sampled, condition, conditions.condition_codes(rules, members), names, small, small_people
    )
    stays = visits.associated_stays(visit, sampled, mode=mode, small_people=small_people)
    er = None
    if include_er:
        er = visits.associated_er_visits(
            visit,
            sampled,
            visits.er_codes(rules, members),
            mode=mode,
            small=small,
            small_people=small_people,
        )
    followed = people.last_death(
        visits.merge_first_visits(
            conditions.condition_flags_by_person(flags, sampled, names), stays, er
        ),
        death,
        latest_only=False,
    )
    located = people.attach_locations(
        followed, person, location, manifest, drop_without_index=True
    )
    return clean_people(located, older=True)


def person_area(
    facts: DataFrame, attributes: DataFrame, crosswalk: DataFrame, summary: DataFrame
) -> DataFrame:
    """Area attributes and disease count of each person, measures as numbers."""
    by_zip = area.zcta_attributes_by_zip(attributes, crosswalk)
    return area.cast_measures(
        area.attach_disease_count(area.attach_area_attributes(facts, by_zip), summary)
    )


def person_places(people_located: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """People with city, state, ZIP and the ZCTA of their ZIP, null where it has none."""
    return area.attach_zcta(people_located, crosswalk).select(
        "person_id", "city", "state", "zip", "zip_code", "ZCTA"
    )


def visit_tables(visit: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cohort's stays with their flag, and its visits outside stays."""
    of_cohort = visits.cohort_visits(visit, dates)
    return (
        visits.flag_stays(visits.cohort_stays(of_cohort), dates),
        visits.cohort_other_visits(of_cohort),
    )
