"""Conditions of cohort people as wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.operators.joins import broadcast_if_small


def newest_members(members: DataFrame) -> DataFrame:
    """Codes of all sets in their newest version."""
    return members.where("is_most_recent_version = 'true'").select("concept_set_name", "concept_id")


def condition_codes(rules: DataFrame, members: DataFrame) -> DataFrame:
    """Codes of the rule sheet's comorbidities, each with its column name."""
    wanted = rules.where(
        F.col("domain").contains("condition_occurrence") & (F.col("comorbidity") == 1)
    ).select("concept_set_name", "column_name")
    return (
        newest_members(members)
        .join(wanted, "concept_set_name")
        .select("concept_id", "column_name")
    )


def condition_names(codes: DataFrame) -> list[str]:
    """Names of the rule sheet's conditions, of which there are a handful, in order.

    `codes` is the rule sheet or the code list made from it.
    """
    if "comorbidity" in codes.columns:
        codes = codes.where(
            F.col("domain").contains("condition_occurrence") & (F.col("comorbidity") == 1)
        )
    return sorted(r[0] for r in codes.select("column_name").distinct().collect() if r[0] is not None)


def _listed(codes: DataFrame, names: Sequence[str] | None) -> list[str]:
    """The names, or those of the codes; a coded condition without a column is an error."""
    found = condition_names(codes)
    if names is None:
        return found
    missing = set(found) - set(names)
    if missing:
        raise ValueError(f"codes hold conditions that are not listed: {sorted(missing)}")
    return list(names)


def _coded(conditions: DataFrame, codes: DataFrame, small: bool | None = None) -> DataFrame:
    listed = broadcast_if_small(
        codes.select(F.col("concept_id").alias("_code"), "column_name"), small=small
    )
    return conditions.where(F.col("condition_start_date").isNotNull()).join(
        listed, F.col("condition_concept_id") == F.col("_code")
    )


def _of_people(grouped: DataFrame, people: DataFrame) -> DataFrame:
    # An inner join: Catalyst moves a semi join below the grouping, where it
    # would shuffle every record instead of the grouped rows.
    return grouped.join(people.select("person_id").distinct(), "person_id")


def first_conditions_wide(
    people: DataFrame,
    conditions: DataFrame,
    codes: DataFrame,
    names: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Per person, the first date of each condition and that record's id.

    Columns are `<name>_start` and `<name>_c_occ_id` for each of `names`, or of
    the codes' names if none are given; a coded name that is not listed is an
    error. `small` tells whether the code list was measured as small already.
    Same-day records are told apart by the smaller id. Records are reduced to
    one row per person, partly before the shuffle, before people are matched.
    """
    names = _listed(codes, names)
    firsts = (
        _coded(conditions, codes, small)
        .groupBy("person_id")
        .agg(
            *[
                F.min(
                    F.when(
                        F.col("column_name") == name,
                        F.struct("condition_start_date", "condition_occurrence_id"),
                    )
                ).alias(name)
                for name in names
            ]
        )
    )
    pairs = []
    for name in names:
        pairs.append(F.col(name)["condition_start_date"].alias(f"{name}_start"))
        pairs.append(F.col(name)["condition_occurrence_id"].alias(f"{name}_c_occ_id"))
    return _of_people(firsts, people).select("person_id", *pairs)


def condition_flags_by_date(
    people: DataFrame,
    conditions: DataFrame,
    codes: DataFrame,
    names: Sequence[str] | None = None,
    small: bool | None = None,
    small_people: bool | None = None,
) -> DataFrame:
    """Per person and date of a coded condition, a 0/1 flag for each of `names`.

    Names as in `first_conditions_wide`. People are matched first: a person has
    about as many dates as records, so grouping before would not save much.
    Ids that measure small are sent to the records; else records and ids meet
    in one shuffle by person, and are grouped where they lie.
    """
    names = _listed(codes, names)
    ids = broadcast_if_small(people.select("person_id").distinct(), small=small_people)
    return (
        _coded(conditions, codes, small)
        .join(ids, "person_id")
        .groupBy("person_id", F.col("condition_start_date").alias("comorbidity_start_date"))
        .agg(
            *[
                F.max(F.coalesce(F.col("column_name") == name, F.lit(False)).cast("int")).alias(name)
                for name in names
            ]
        )
    )


def condition_flags_by_person(
    flags: DataFrame, people: DataFrame, names: Sequence[str]
) -> DataFrame:
    """People with the highest of each flag; people without conditions get 0."""
    by_person = flags.groupBy("person_id").agg(*[F.max(name).alias(name) for name in names])
    return people.join(by_person, "person_id", "left").fillna(0, subset=list(names))
