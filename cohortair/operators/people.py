"""Person facts: sampling, places, cleaning, death, severity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.functions.demographics import (
    RACE_RULES,
    birth_date,
    five_digit_zip,
    full_years,
    gender_label,
    label_by_rules,
)
from cohortair.operators.joins import attach
from cohortair.settings import LAB_INDEX, LAB_OR_DIAGNOSIS_INDEX


def sample_cohort(
    cohort: DataFrame, fraction: float = 1.0, seed: int = 111, stable_key: str | None = "person_id"
) -> DataFrame:
    """Sample of rows without replacement; the default keeps all.

    A hash of `stable_key` and the seed decides, so the same people are drawn
    on any cluster and in every use of the sample. Without a key it is Spark's
    sample, which depends on how rows lie in partitions.
    """
    if fraction >= 1.0:
        return cohort
    if stable_key is None:
        return cohort.sample(False, fraction, seed)
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(stable_key)))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2**32)
    return cohort.where(share < fraction)


def attach_locations(
    cohort: DataFrame,
    person: DataFrame,
    location: DataFrame,
    manifest: DataFrame,
    drop_without_index: bool = False,
) -> DataFrame:
    """Birth parts, race, ethnicity, gender, place and site run data.

    `drop_without_index` is the older form: people without a lab or diagnosis
    date go first, and so does the column of the earliest of all dates.
    """
    if drop_without_index:
        cohort = cohort.where(F.col(LAB_OR_DIAGNOSIS_INDEX).isNotNull()).drop(
            "first_antigen_or_poslab_or_diagnosis_date"
        )
    people = cohort.join(
        person.select(
            "person_id",
            "year_of_birth",
            "month_of_birth",
            "day_of_birth",
            "ethnicity_concept_name",
            "race_concept_name",
            "gender_concept_name",
            "location_id",
            "data_partner_id",
        ),
        "person_id",
        "left",
    )
    placed = attach(
        people, location.select("location_id", "city", "state", "zip", "county"), "location_id"
    )
    sites = manifest.select(
        "data_partner_id", "run_date", "cdm_name", "cdm_version", "shift_date_yn", "max_num_shift_days"
    )
    return attach(placed, sites, "data_partner_id")


def birth_and_age(
    people: DataFrame, index_date: str = LAB_INDEX, keep_negative: bool = False
) -> DataFrame:
    """Date of birth and age in full years at the index date.

    A negative age becomes null unless kept, as the older form does.
    """
    dated = people.withColumn(
        "date_of_birth", birth_date("year_of_birth", "month_of_birth", "day_of_birth")
    )
    age = full_years(index_date, "date_of_birth")
    return dated.withColumn(
        "age_at_first_covid_diag", age if keep_negative else F.when(age >= 0, age)
    )


def standard_gender(people: DataFrame) -> DataFrame:
    """Adds `gender`: MALE, FEMALE or UNKNOWN."""
    return people.withColumn("gender", gender_label("gender_concept_name"))


def race_ethnicity(people: DataFrame, rules=RACE_RULES) -> DataFrame:
    """Adds `race_ethnicity` from the first rule that holds."""
    return people.withColumn("race_ethnicity", label_by_rules(rules))


def clean_zip(people: DataFrame) -> DataFrame:
    """Adds `zip_code`: the five digits of `zip`, or null."""
    return people.withColumn("zip_code", five_digit_zip("zip"))


def last_death(people: DataFrame, death: DataFrame, latest_only: bool = True) -> DataFrame:
    """Latest death date of each person and whether one is recorded.

    `latest_only=False` is the older form: every death record of a person is
    joined with all its columns but the site's id.
    """
    if not latest_only:
        return people.join(death.drop("data_partner_id"), "person_id", "left")
    latest = death.groupBy("person_id").agg(F.max("death_date").alias("death_date"))
    return people.join(latest, "person_id", "left").withColumn(
        "death_recorded", F.col("death_date").isNotNull().cast("int")
    )


def attach_severity(people: DataFrame, scores: DataFrame) -> DataFrame:
    """Severity, body measures and smoking of the person's critical visit."""
    return people.join(
        scores.select(
            "person_id",
            "Severity_Type",
            F.col("data_partner_id").alias("sev_data_partner_id"),
            F.col("visit_start_date").alias("sev_visit_start_date"),
            F.col("visit_occurrence_id").alias("sev_visit_occurrence_id"),
            "AKI_in_hospital",
            "ECMO",
            "Invasive_Ventilation",
            "Q_Score",
            "BMI",
            "Height",
            "Weight",
            "blood_type",
            "smoking_status",
        ),
        "person_id",
        "left",
    )
