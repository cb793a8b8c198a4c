"""Visits and hospital stays around a positive date.

A stay is a run of visits with one `macrovisit_id`; a visit without one lies
outside any stay. Windows reach from `pre` days ahead of the index date to
`post` days past it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortair.functions.days import days_around
from cohortair.operators.conditions import newest_members
from cohortair.operators.joins import broadcast_if_small, fits_broadcast
from cohortair.settings import LAB_INDEX, LAB_OR_DIAGNOSIS_INDEX, PCR_ANTIGEN_LABEL

STAY = ["macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"]


def er_codes(rules: DataFrame, members: DataFrame) -> DataFrame:
    """Visit codes of the rule sheet's emergency-room sets."""
    wanted = rules.where("er_only_visit = 1").select("concept_set_name")
    return (
        newest_members(members).join(wanted, "concept_set_name", "left_semi").select("concept_id")
    )


def _window_index(people: DataFrame, mode: str, before: int, after: int) -> DataFrame:
    """Person and the date their visits are measured from."""
    if mode == "either":
        return people.select("person_id", F.col(LAB_OR_DIAGNOSIS_INDEX).alias("index_date"))
    if mode == "both":
        gap = F.datediff(F.col(LAB_INDEX), F.col("first_pos_diagnosis_date"))
        return people.where(gap.between(-after, before)).select(
            "person_id", F.col(LAB_INDEX).alias("index_date")
        )
    raise ValueError("mode is 'either' or 'both'")


def of_people(visits: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """Visits of the given people, where their ids measure small; else all visits.

    Drops visits before any shuffle if that is cheap. The joins by person that
    follow give the same rows either way. `small` is the answer where the ids
    were measured already.
    """
    ids = people.select("person_id").distinct()
    if small is None:
        small = fits_broadcast(ids)
    return visits.join(F.broadcast(ids), "person_id", "left_semi") if small else visits


def associated_er_visits(
    visits: DataFrame,
    people: DataFrame,
    codes: DataFrame,
    before: int = 1,
    after: int = 16,
    mode: str = "either",
    small: bool | None = None,
    small_people: bool | None = None,
) -> DataFrame:
    """First emergency-room visit per person near the index date, outside stays.

    "either" measures from the first lab or diagnosis date; "both" from the lab
    date, and the diagnosis must lie as near to it.
    """
    listed = broadcast_if_small(codes.select(F.col("concept_id").alias("_code")), small=small)
    er_days = (
        of_people(visits, people, small_people)
        .where(F.col("macrovisit_start_date").isNull())
        .join(listed, F.col("visit_concept_id") == F.col("_code"), "left_semi")
        .select("person_id", "visit_start_date")
    )
    near = days_around(
        _window_index(people, mode, before, after), "index_date", before, after, "visit_start_date"
    )
    return (
        er_days.join(near, ["person_id", "visit_start_date"])
        .groupBy("person_id")
        .agg(F.min("visit_start_date").alias("first_covid_er_only_start_date"))
    )


def associated_stays(
    visits: DataFrame,
    people: DataFrame,
    before: int = 1,
    after: int = 16,
    mode: str = "either",
    small_people: bool | None = None,
) -> DataFrame:
    """First stay per person that starts near the index date.

    The records of a stay are not reduced to one first: the minimum doesn't
    mind repeats, and reducing would cost a shuffle of its own.
    """
    stays = (
        of_people(visits, people, small_people)
        .where(F.col("macrovisit_start_date").isNotNull())
        .select("person_id", *STAY)
    )
    near = days_around(
        _window_index(people, mode, before, after),
        "index_date",
        before,
        after,
        "macrovisit_start_date",
    )
    first = F.min(F.struct("macrovisit_start_date", "macrovisit_id", "macrovisit_end_date"))
    return (
        stays.join(near, ["person_id", "macrovisit_start_date"])
        .groupBy("person_id")
        .agg(first.alias("s"))
        .select(
            "person_id",
            "s.macrovisit_id",
            F.col("s.macrovisit_start_date").alias("first_COVID_hospitalization_start_date"),
            F.col("s.macrovisit_end_date").alias("first_COVID_hospitalization_end_date"),
        )
    )


def merge_first_visits(
    people: DataFrame, stays: DataFrame, er: DataFrame | None = None
) -> DataFrame:
    """People with their first stay and, if given, first emergency-room visit."""
    merged = people.join(stays, "person_id", "left")
    return merged if er is None else merged.join(er, "person_id", "left")


def first_covid_stay(
    people: DataFrame,
    visits: DataFrame,
    pre: int = 1,
    post: int = 16,
    index_date: str = LAB_INDEX,
    small_people: bool | None = None,
) -> DataFrame:
    """People with their first stay near the index date, if any, and a 0/1 flag.

    The stay starts in the window and does not end before the index date. Of
    stays that start on one day the smaller id is first.
    """
    stays = _stay_records(of_people(visits, people, small_people))
    near = days_around(
        people.select("person_id", F.col(index_date).alias("index_date")),
        "index_date",
        pre,
        post,
        "macrovisit_start_date",
    )
    first = F.min(F.struct("macrovisit_start_date", "macrovisit_id", "macrovisit_end_date"))
    firsts = (
        stays.join(near, ["person_id", "macrovisit_start_date"])
        .where("index_date <= macrovisit_end_date")
        .groupBy("person_id")
        .agg(first.alias("s"))
        .select(
            "person_id",
            F.col("s.macrovisit_id").alias("first_covid_macrovisit_id"),
            F.col("s.macrovisit_start_date").alias("first_covid_macrovisit_start_date"),
            F.col("s.macrovisit_end_date").alias("first_covid_macrovisit_end_date"),
        )
    )
    return people.join(firsts, "person_id", "left").withColumn(
        "covid_associated_hosp", F.col("first_covid_macrovisit_id").isNotNull().cast("int")
    )


def later_stays(
    people: DataFrame,
    visits: DataFrame,
    index_date: str = LAB_OR_DIAGNOSIS_INDEX,
    stay_start: str = "first_COVID_hospitalization_start_date",
    stay_end: str = "first_COVID_hospitalization_end_date",
    small_people: bool | None = None,
) -> DataFrame:
    """Stays that start after the associated stay, or after the index date.

    One row per person and stay, the stay's earliest later record. Records are
    shuffled once, by person, and grouped where they lie.
    """
    since = people.select("person_id", index_date, stay_start, stay_end)
    records = _stay_records(of_people(visits, people, small_people))
    later = records.join(since, "person_id").where(
        F.coalesce(F.col(stay_start), F.col(index_date)) < F.col("macrovisit_start_date")
    )
    first = F.min(F.struct("macrovisit_start_date", "macrovisit_end_date"))
    return (
        later.groupBy("person_id", index_date, stay_start, stay_end, "macrovisit_id")
        .agg(first.alias("s"))
        .select(
            "person_id",
            index_date,
            stay_start,
            stay_end,
            "macrovisit_id",
            "s.macrovisit_start_date",
            "s.macrovisit_end_date",
        )
    )


def positive_lab_dates(dates: DataFrame) -> DataFrame:
    """Positive dates that come from a PCR or antigen test."""
    return dates.where(F.col("covid_event_type") == PCR_ANTIGEN_LABEL)


def cohort_visits(visits: DataFrame, dates: DataFrame) -> DataFrame:
    """All visits of people who have a positive date."""
    return visits.join(dates.select("person_id").distinct(), "person_id", "left_semi")


def _stay_records(visits: DataFrame) -> DataFrame:
    """Each visit's stay, repeats and all."""
    return visits.where(F.col("macrovisit_id").isNotNull()).select("person_id", *STAY)


def cohort_stays(visits: DataFrame, keep_partner: bool = True) -> DataFrame:
    """Distinct stays of the visits."""
    owner = ["person_id", "data_partner_id"] if keep_partner else ["person_id"]
    return visits.where(F.col("macrovisit_id").isNotNull()).select(*owner, *STAY).distinct()


def cohort_other_visits(visits: DataFrame) -> DataFrame:
    """Visits outside any stay, without the stay columns."""
    return visits.where(F.col("macrovisit_id").isNull()).drop(*STAY)


def flag_stays(
    stays: DataFrame, dates: DataFrame, pre: int = 1, post: int = 16
) -> DataFrame:
    """All stays, flagged where a positive date falls near the start.

    The start lies in the window of the date and the stay does not end before
    it; `poslab_date` is the earliest such date. For one start day only the
    earliest date in reach matters: if that one is past the stay's end, so are
    all others. So dates are opened into the start days they cover and reduced
    to one per person and day before stays are matched, and dates and stays of
    a person are never paired off with each other.
    """
    in_reach = (
        days_around(
            dates.select("person_id", F.col("covid_date").alias("poslab_date")),
            "poslab_date",
            pre,
            post,
            "macrovisit_start_date",
        )
        .groupBy("person_id", "macrovisit_start_date")
        .agg(F.min("poslab_date").alias("poslab_date"))
    )
    # All rows of a stay share its earliest date. An id names one stay, so its
    # distinct rows are few as long as ids are real; a window reads them once
    # where a join back would read them twice.
    of_stay = Window.partitionBy("macrovisit_id")
    near = F.when(F.col("poslab_date") <= F.col("macrovisit_end_date"), F.col("poslab_date"))
    return (
        stays.join(in_reach, ["person_id", "macrovisit_start_date"], "left")
        .withColumn("poslab_date", F.min(near).over(of_stay))
        .select(
            "person_id",
            "macrovisit_id",
            F.col("poslab_date").isNotNull().cast("int").alias("covid_associated_hosp"),
            "poslab_date",
            "macrovisit_start_date",
            "macrovisit_end_date",
            "data_partner_id",
        )
    )
