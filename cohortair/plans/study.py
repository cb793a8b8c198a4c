"""The whole study, each shared table published once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortair.operators import cohort as base
from cohortair.operators import people, visits
from cohortair.plans import cohort, environment
from cohortair.settings import CodeSetNames, Pollutant
from cohortair.sources.tables import publish


def publish_study(
    folder: str,
    labs: DataFrame,
    diagnoses: DataFrame,
    names: CodeSetNames,
    person: DataFrame,
    location: DataFrame,
    manifest: DataFrame,
    visit: DataFrame,
    death: DataFrame,
    climate_years: Sequence[DataFrame],
    readings: DataFrame,
    crosswalk: DataFrame,
    pairs: DataFrame,
    pollutants: Sequence[Pollutant],
    fraction: float = 1.0,
) -> dict[str, DataFrame]:
    """From tagged events to published tables of a new folder, by name.

    patients, facts, places, dates, stays, other_visits, climate and an
    air_<pollutant> each. What later tables need is read back from the stored
    ones, so it is worked out once; the cohort is sampled once, at the start.
    """
    made: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, *cluster_by: str) -> DataFrame:
        made[name] = publish(df, name, folder, cluster_by)
        return made[name]

    events = base.first_event_dates(labs, diagnoses, names)
    patients = keep("patients", people.sample_cohort(events, fraction), "person_id")
    facts = keep(
        "facts",
        cohort.person_fact(patients, person, location, manifest, visit, death),
        "person_id",
    )
    keep("places", cohort.person_places(facts, crosswalk), "person_id")
    dates = keep(
        "dates",
        base.positive_dates(labs, diagnoses, names).join(
            patients.select("person_id"), "person_id", "left_semi"
        ),
    )
    of_cohort = keep("visits", visits.cohort_visits(visit, dates), "person_id")
    keep("stays", visits.flag_stays(visits.cohort_stays(of_cohort), dates))
    keep("other_visits", visits.cohort_other_visits(of_cohort))
    keep("climate", environment.climate_by_lag(facts, climate_years), "person_id")
    for kind in pollutants:
        series = environment.pollutant_series(readings, facts, crosswalk, pairs, kind)
        keep(f"air_{kind.name}", series, "zip_code")
    return made
