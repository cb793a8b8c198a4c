"""Who is in the cohort and since when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortair.operators.joins import attach
from cohortair.settings import (
    ANTIBODY_LABEL,
    DIAGNOSIS_LABEL,
    LAB_INDEX,
    OTHER_DIAGNOSIS_LABEL,
    PCR_ANTIGEN_LABEL,
    CodeSetNames,
)


def first_event_dates(
    labs: DataFrame, diagnoses: DataFrame, names: CodeSetNames, poslab_only: bool = True
) -> DataFrame:
    """First date per person of each kind of event.

    With `poslab_only`, people with a PCR or antigen date and that date alone.
    Otherwise all people with the three dates, the earliest of lab and
    diagnosis, the earliest of all, and the kind that set it (a tie goes to
    PCR or antigen, then to the diagnosis).
    """
    if poslab_only:
        return (
            labs.where(F.col("concept_set_name") == names.pcr_antigen)
            .groupBy("person_id")
            .agg(F.min("measurement_date").alias(LAB_INDEX))
            .where(F.col(LAB_INDEX).isNotNull())
        )
    events = labs.select(
        "person_id",
        F.col("measurement_date").alias("day"),
        F.when(F.col("concept_set_name") == names.pcr_antigen, "pcr")
        .otherwise("antibody")
        .alias("kind"),
    )
    events = events.unionByName(
        diagnoses.where(F.col("concept_set_name") == names.diagnosis).select(
            "person_id", F.col("condition_start_date").alias("day"), F.lit("diagnosis").alias("kind")
        )
    )

    def earliest(kind: str):
        return F.min(F.when(F.col("kind") == kind, F.col("day")))

    pcr, diagnosis, antibody = (
        F.col(c) for c in (LAB_INDEX, "first_pos_diagnosis_date", "first_pos_antibody_date")
    )
    of_all = F.least(pcr, antibody, diagnosis)
    return (
        events.groupBy("person_id")
        .agg(
            earliest("pcr").alias(LAB_INDEX),
            earliest("diagnosis").alias("first_pos_diagnosis_date"),
            earliest("antibody").alias("first_pos_antibody_date"),
        )
        .select(
            "person_id",
            F.when(of_all == pcr, PCR_ANTIGEN_LABEL)
            .when(of_all == diagnosis, DIAGNOSIS_LABEL)
            .when(of_all == antibody, ANTIBODY_LABEL)
            .alias("covid_event_type"),
            pcr,
            diagnosis,
            antibody,
            F.least(pcr, diagnosis).alias("first_poslab_or_diagnosis_date"),
            of_all.alias("first_antigen_or_poslab_or_diagnosis_date"),
        )
    )


def positive_dates(
    labs: DataFrame,
    diagnoses: DataFrame,
    names: CodeSetNames,
    poslab_only: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """All distinct positive dates of each person, with the event's set and label.

    Of the labs only PCR and antigen tests count. Row order is not part of a
    table, so the sort by person and date is left out unless asked for.
    """
    found = labs.where(F.col("concept_set_name") == names.pcr_antigen).select(
        "person_id",
        F.col("measurement_date").alias("covid_date"),
        "concept_set_name",
        F.lit(PCR_ANTIGEN_LABEL).alias("covid_event_type"),
    )
    if not poslab_only:
        found = found.unionByName(
            diagnoses.select(
                "person_id",
                F.col("condition_start_date").alias("covid_date"),
                "concept_set_name",
                F.when(F.col("concept_set_name") == names.diagnosis, DIAGNOSIS_LABEL)
                .otherwise(OTHER_DIAGNOSIS_LABEL)
                .alias("covid_event_type"),
            )
        )
    found = found.distinct()
    return found.orderBy("person_id", "covid_date") if ordered else found


def days_since_previous(dates: DataFrame) -> DataFrame:
    """Each person's distinct dates with the days since the one before.

    Dates are made distinct first, so a person's group is never longer than
    the calendar.
    """
    by_person = Window.partitionBy("person_id").orderBy("covid_date")
    return (
        dates.select("person_id", "covid_date")
        .distinct()
        .withColumn(
            "days_since_pos_pcr_antigen",
            F.datediff("covid_date", F.lag("covid_date").over(by_person)),
        )
    )


def attach_people(cohort: DataFrame, person: DataFrame, location: DataFrame) -> DataFrame:
    """All person and location columns for the cohort, for looking at it."""
    return attach(
        cohort.join(person, "person_id", "left"), location.drop("data_partner_id"), "location_id"
    )
