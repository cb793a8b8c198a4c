"""One query per operator or flow, over the study tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.functions.demographics import RACE_RULES_OLDER
from cohortair.operators import (
    air,
    area,
    checks,
    climate,
    codes,
    cohort,
    conditions,
    people,
    timeseries,
    visits,
)
from cohortair.plans import cohort as cohort_plan
from cohortair.plans import environment
from cohortair.settings import NO2, OZONE, PM25, PM25_OLDER, SO2
from cohortair.sources.session import tune
from cohortair.operators.joins import attach
from cohortair.plans import study as study_plan
from cohortair.sources.tables import new_folder, publish
from workload.standins import NAMES, PRIORITY_NAMES, Study

QUERIES = {}
EVENT_COLUMNS = (
    "first_pos_pcr_antigen_date",
    "first_pos_diagnosis_date",
    "first_pos_antibody_date",
    "first_poslab_or_diagnosis_date",
    "first_antigen_or_poslab_or_diagnosis_date",
)


def query(fn):
    """Registers a function of the study tables under its name."""

    def run(spark, folder: str) -> DataFrame:
        return fn(Study(tune(spark), folder))

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles as the nearest single: their last bits depend on the order of summing.

    Rounding to decimal places would not do: halves and quarters of days fall
    right between two of them.
    """
    doubles = {c: F.col(c).cast("float").cast("double") for c, t in df.dtypes if t == "double"}
    return df.withColumns(doubles) if doubles else df


# Code lists and base cohort


@query
def code_set(s):
    return codes.union_code_sets(
        codes.code_set(s.members(), NAMES.pcr_antigen), codes.code_set(s.members(), NAMES.antibody)
    )


@query
def tag_positive(s):
    return cohort_plan.tagged_events(s.members(), s.measurement(), s.conditions(), NAMES)[0]


@query
def tag_diagnoses(s):
    return cohort_plan.tagged_events(s.members(), s.measurement(), s.conditions(), NAMES)[1]


@query
def first_events(s):
    return cohort.first_event_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES)


@query
def first_events_all(s):
    return cohort.first_event_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES, poslab_only=False)


@query
def base_cohort(s):
    labs, diagnoses = cohort_plan.tagged_events(
        s.members(), s.measurement(), s.conditions(), NAMES
    )
    return cohort.first_event_dates(labs, diagnoses, NAMES, poslab_only=False)


@query
def positive_dates_all(s):
    return cohort.positive_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES, poslab_only=False)


@query
def positive_dates(s):
    return cohort.positive_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES)


@query
def positive_gaps(s):
    return cohort.days_since_previous(cohort.positive_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES))


@query
def positive_gaps_all(s):
    return cohort.days_since_previous(
        cohort.positive_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES, poslab_only=False)
    )


def _patients(s) -> DataFrame:
    return cohort.first_event_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES, poslab_only=False)


@query
def attach_people(s):
    return cohort.attach_people(first_events(s), s.person(), s.location())


# Person facts


@query
def sample_all(s):
    return people.sample_cohort(first_events(s))


@query
def sample_stable(s):
    return people.sample_cohort(first_events(s), 0.3, stable_key="person_id")


@query
def attach_locations(s):
    return people.attach_locations(first_events(s), s.person(), s.location(), s.manifest())


@query
def attach_locations_older(s):
    return people.attach_locations(
        _patients(s), s.person(), s.location(), s.manifest(), drop_without_index=True
    )


@query
def age(s):
    indexed = first_events(s).join(s.person(), "person_id")
    return people.birth_and_age(indexed).select(
        "person_id", "date_of_birth", "age_at_first_covid_diag"
    )


@query
def age_older(s):
    indexed = _patients(s).join(s.person(), "person_id")
    return people.birth_and_age(
        indexed, "first_poslab_or_diagnosis_date", keep_negative=True
    ).select("person_id", "date_of_birth", "age_at_first_covid_diag")


@query
def gender(s):
    return people.standard_gender(s.person()).select("person_id", "gender")


@query
def race(s):
    return people.race_ethnicity(s.person()).select("person_id", "race_ethnicity")


@query
def race_older(s):
    return people.race_ethnicity(s.person(), RACE_RULES_OLDER).select("person_id", "race_ethnicity")


def _placed(s) -> DataFrame:
    return people.clean_zip(attach(s.person(), s.location(), "location_id"))


@query
def clean_zip(s):
    return _placed(s).select("person_id", "zip", "zip_code")


@query
def condition_codes(s):
    return conditions.condition_codes(s.rules(), s.members())


@query
def conditions_wide(s):
    return conditions.first_conditions_wide(
        first_events(s), s.conditions(), condition_codes(s)
    )


@query
def condition_flags(s):
    return conditions.condition_flags_by_date(
        first_events(s), s.conditions(), condition_codes(s)
    )


@query
def condition_flags_person(s):
    return conditions.condition_flags_by_person(
        condition_flags(s), first_events(s), conditions.condition_names(s.rules())
    )


@query
def er_codes(s):
    return visits.er_codes(s.rules(), s.members())


@query
def er_first_either(s):
    return visits.associated_er_visits(s.visits(), _patients(s), er_codes(s))


@query
def er_first_both(s):
    return visits.associated_er_visits(
        s.visits(), _patients(s), er_codes(s), before=30, after=90, mode="both"
    )


@query
def stays_either(s):
    return visits.associated_stays(s.visits(), _patients(s))


@query
def stays_both(s):
    return visits.associated_stays(s.visits(), _patients(s), before=30, after=90, mode="both")


@query
def visit_merge(s):
    return visits.merge_first_visits(_patients(s), stays_either(s), er_first_either(s))


@query
def first_stay(s):
    return visits.first_covid_stay(first_events(s), s.visits())


@query
def later_stays(s):
    merged = visits.merge_first_visits(_patients(s), stays_either(s))
    return visits.later_stays(merged, s.visits())


@query
def last_death(s):
    return people.last_death(first_events(s), s.death())


@query
def death_older(s):
    return people.last_death(first_events(s), s.death(), latest_only=False)


@query
def severity(s):
    return people.attach_severity(first_events(s), s.scores())


@query
def area_by_zip(s):
    return area.zcta_attributes_by_zip(s.area_attributes(), s.crosswalk_base())


@query
def people_area(s):
    return cohort_plan.person_area(
        s.people_zips(), s.area_attributes(), s.crosswalk_base(), s.summary()
    )


@query
def unmatched_areas(s):
    return area.unmatched_areas(cohort_plan.person_places(_placed(s), s.crosswalk_base()))


@query
def zip_counts(s):
    return area.count_by(s.people_zips(), "zip_code")


@query
def zip_counts_raw(s):
    return area.count_by(attach(s.person(), s.location(), "location_id"), "zip")


@query
def stay_code_counts(s):
    return checks.stay_code_counts(
        s.visits().withColumn("visit_concept_id", F.ascii("visit_concept_name")), code=ord("R")
    )


@query
def stay_detail(s):
    return checks.stay_detail(s.visits(), 7)


@query
def person_stays(s):
    return checks.person_stays(s.visits(), 7)


@query
def person_fact(s):
    return cohort_plan.person_fact(
        first_events(s), s.person(), s.location(), s.manifest(), s.visits(), s.death()
    )


@query
def person_fact_older(s):
    return cohort_plan.person_fact_older(
        _patients(s),
        s.person(),
        s.location(),
        s.manifest(),
        s.visits(),
        s.death(),
        s.conditions(),
        s.members(),
        s.rules(),
    )


def _older(s, **options) -> DataFrame:
    return cohort_plan.person_fact_older(
        _patients(s), s.person(), s.location(), s.manifest(), s.visits(), s.death(),
        s.conditions(), s.members(), s.rules(), **options,
    )


@query
def person_fact_older_both(s):
    return _older(s, mode="both")


@query
def person_fact_older_no_er(s):
    return _older(s, include_er=False)


@query
def person_fact_sample(s):
    return cohort_plan.person_fact(
        first_events(s), s.person(), s.location(), s.manifest(), s.visits(), s.death(), fraction=0.3
    )


@query
def publish_cohort(s):
    folder = new_folder(s.spark)
    return publish(first_events_all(s), "patients", folder, cluster_by=("person_id",))


def _study(s, *pollutants) -> dict[str, DataFrame]:
    return study_plan.publish_study(
        new_folder(s.spark), s.labs(), s.diagnoses(), PRIORITY_NAMES, s.person(), s.location(),
        s.manifest(), s.visits(), s.death(), [s.climate(True), s.climate(False)], s.readings(),
        crosswalk(s), s.monitor_pairs(), pollutants,
    )


@query
def study_areas(s):
    """From the source tables to published ones; then the places of people without a ZCTA."""
    return area.unmatched_areas(_study(s)["places"])


@query
def study_air(s):
    """The same; then the daily NO2 of each ZIP of the published cohort."""
    return rounded(_study(s, NO2)["air_NO2"])


# Visits


def _dates(s) -> DataFrame:
    return cohort.positive_dates(s.labs(), s.diagnoses(), PRIORITY_NAMES)


@query
def positive_lab_dates(s):
    return visits.positive_lab_dates(positive_dates_all(s))


@query
def cohort_visits(s):
    return visits.cohort_visits(s.visits(), _dates(s))


@query
def cohort_stays(s):
    return visits.cohort_stays(s.visits())


@query
def other_visits(s):
    return visits.cohort_other_visits(s.visits())


@query
def flag_stays(s):
    return cohort_plan.visit_tables(s.visits(), _dates(s))[0]


@query
def cohort_other_visits(s):
    return cohort_plan.visit_tables(s.visits(), _dates(s))[1]


# Climate


def _climate(s) -> DataFrame:
    return climate.stack_years(s.climate(True), s.climate(False))


@query
def stack_years(s):
    return _climate(s)


@query
def shared_zips(s):
    return climate.shared_zips(s.people_zips(), _climate(s))


@query
def climate_for_zips(s):
    return climate.climate_for_zips(_climate(s), shared_zips(s))


@query
def people_with_climate(s):
    return climate.people_with_climate(s.people_zips(), _climate(s))


@query
def expand_lags(s):
    return climate.expand_lags(s.people_zips())


@query
def climate_by_lag(s):
    return environment.climate_by_lag(s.people_zips(), [s.climate(True), s.climate(False)])


@query
def distinct_zips(s):
    return climate.distinct_zips(s.people_zips())


@query
def climate_zips(s):
    return climate.distinct_zips(_climate(s), "POSTCODE")


@query
def unmatched_zips(s):
    return climate.unmatched_zips(s.people_zips(), s.crosswalk_update().select(
        F.col("ZIP_CODE").alias("POSTCODE")
    ))


@query
def unmatched_zips_from(s):
    return climate.unmatched_zips(s.people_zips(), _climate(s), start=2)


@query
def covered_people(s):
    return climate.count_covered_people(climate_by_lag(s))


@query
def covered_unshifted(s):
    return climate.count_unshifted_covered(s.people_zips(), climate_by_lag(s))


# Air quality


@query
def crosswalk(s):
    return area.zip_zcta_crosswalk(s.crosswalk_base(), s.crosswalk_update())


@query
def crosswalk_whole_rows(s):
    return area.zip_zcta_crosswalk(s.crosswalk_base(), s.crosswalk_update(), whole_rows=True)


@query
def cohort_zips(s):
    return area.cohort_zips(s.people_zips())


@query
def cohort_zips_person(s):
    return area.cohort_zips(s.people_zips(), person_id=7, distinct=False)


def _zip_zcta(s) -> DataFrame:
    return area.zips_to_zcta(cohort_zips(s), crosswalk(s))


@query
def zips_to_zcta(s):
    return _zip_zcta(s)


@query
def zcta_monitors(s):
    return area.zcta_monitors(s.monitor_pairs())


@query
def zcta_monitors_older(s):
    plain = s.monitor_pairs().select(
        F.col("ZCTA").alias("zcta"), F.col("Monitor_ID").alias("monitor")
    )
    return area.zcta_monitors(plain, older=True)


@query
def zcta_monitors_one(s):
    return area.zcta_monitors(s.monitor_pairs(), zcta="90003")


def _nearby(s, dedupe: bool = True) -> DataFrame:
    return area.nearby_monitors(_zip_zcta(s), zcta_monitors(s), dedupe)


@query
def nearby_monitors(s):
    return _nearby(s)


@query
def nearby_monitors_repeated(s):
    return _nearby(s, dedupe=False)


@query
def monitors_with_data(s):
    return area.monitors_with_data(_selected(s, PM25), _nearby(s, dedupe=False))


def _selected(s, kind) -> DataFrame:
    return air.pollutant(s.readings(), kind.code, kind.keep)


@query
def select_no2(s):
    return _selected(s, NO2)


@query
def select_ozone(s):
    return _selected(s, OZONE)


@query
def select_pm25(s):
    return _selected(s, PM25)


@query
def select_so2(s):
    return _selected(s, SO2)


@query
def nullify_below(s):
    return air.nullify_below(_selected(s, PM25)).select(
        "aqs_site_id", "DateLocal", "ArithmeticMean", "SampleDuration", "ObservationCount"
    )


@query
def best_reading(s):
    return air.best_reading(air.nullify_below(_selected(s, NO2)))


@query
def best_by_duration(s):
    return air.best_by_duration(air.nullify_below(_selected(s, SO2)), SO2.durations)


@query
def daily_by_duration(s):
    return air.daily_by_duration(air.nullify_below(_selected(s, PM25)), PM25.durations)


@query
def fill_calendar(s):
    return timeseries.fill_calendar(best_reading(s), day="DateLocal")


def _daily(s, kind) -> DataFrame:
    return air.daily_series(_selected(s, kind), kind)


@query
def daily_best(s):
    return _daily(s, OZONE)


@query
def daily_pick(s):
    return rounded(_daily(s, PM25))


@query
def daily_pick_so2(s):
    return rounded(_daily(s, SO2))


@query
def daily_mean(s):
    return rounded(_daily(s, PM25_OLDER))


@query
def zip_readings(s):
    return air.zip_readings(_daily(s, NO2), _nearby(s))


@query
def zip_daily(s):
    return rounded(air.zip_daily(air.zip_readings(_daily(s, PM25), _nearby(s, dedupe=False), dedupe=False), PM25))


@query
def trailing(s):
    daily = _daily(s, NO2).withColumnRenamed("measurement", "measurement_avg")
    return rounded(timeseries.trailing(daily, site="aqs_site_id"))


@query
def label_series(s):
    return air.label_series(cohort_zips(s), select_so2(s))


def _series(s, kind) -> DataFrame:
    return rounded(
        environment.pollutant_series(
            s.readings(), s.people_zips(), crosswalk(s), s.monitor_pairs(), kind
        )
    )


@query
def zip_series_no2(s):
    return _series(s, NO2)


@query
def zip_series_ozone(s):
    return _series(s, OZONE)


@query
def zip_series_pm25(s):
    return _series(s, PM25)


@query
def zip_series_so2(s):
    return _series(s, SO2)


@query
def zip_series_pm25_older(s):
    return _series(s, PM25_OLDER)


@query
def max_count_check(s):
    return checks.max_count_check(_selected(s, OZONE))


@query
def max_count_check_duration(s):
    return checks.max_count_check(
        _selected(s, SO2), ("aqs_site_id", "DateLocal", "SampleDuration")
    )


@query
def repeat_readings(s):
    return checks.repeat_readings(_selected(s, NO2))


@query
def repeat_readings_duration(s):
    return checks.repeat_readings(_selected(s, SO2), ("aqs_site_id", "DateLocal", "SampleDuration"))


@query
def compare_methods(s):
    # Odd sites as one, so that days hold several readings.
    odd = s.readings().withColumn("aqs_site_id", F.pmod("aqs_site_id", F.lit(2)))
    return checks.compare_methods(odd, 1, SO2.code, "1 HOUR", (5, 6, 7))
