"""Code lists and the facts they select (A1 to A4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortair.operators.joins import broadcast_if_small


def code_set(members: DataFrame, name: str) -> DataFrame:
    """Rows of one named code set in its newest, released version."""
    return members.where(
        (F.col("concept_set_name") == name)
        & (F.col("is_most_recent_version") == "true")
        & F.col("version").isNotNull()
    )


def union_code_sets(*sets: DataFrame) -> DataFrame:
    """Set union on whole rows.

    A code that is in two sets stays as two rows and selects its facts twice.
    """
    return reduce(DataFrame.unionByName, sets).distinct()


def tag_facts(
    facts: DataFrame, codes: DataFrame, key: str, small: bool | None = None
) -> DataFrame:
    """Facts whose `key` is a listed code, with the code and its set's name.

    The list is measured before it is broadcast, unless `small` tells.
    """
    listed = broadcast_if_small(codes.select("concept_set_name", "concept_id"), small=small)
    return facts.join(listed, facts[key] == listed["concept_id"])


def positive_results(
    tests: DataFrame,
    positives: DataFrame,
    key: str = "value_as_concept_id",
    small: bool | None = None,
) -> DataFrame:
    """Tests whose result is a listed code; no column is added.

    A code listed twice keeps its tests twice.
    """
    listed = broadcast_if_small(
        positives.select(F.col("concept_id").alias("_positive")), small=small
    )
    return tests.join(listed, tests[key] == listed["_positive"]).drop("_positive")
