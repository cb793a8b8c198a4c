"""Birth date, age, gender, race and ZIP as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels and texts below, in rule order; the first rule that
# holds gives the label. Texts are matched with regard to case.
HISPANIC = "Hispanic or Latino Any Race"
BLACK = "Black or African American Non-Hispanic"
WHITE = "White Non-Hispanic"
ASIAN = "Asian Non-Hispanic"
PACIFIC = "Native Hawaiian or Other Pacific Islander Non-Hispanic"
OTHER = "Other Non-Hispanic"
NO_LABEL = "UNKNOWN"

ETHNICITY = "ethnicity_concept_name"
RACE = "race_concept_name"

ASIAN_TEXTS = (
    "Asian",
    "Filipino",
    "Chinese",
    "Korean",
    "Vietnamese",
    "Japanese",
    "Bangladeshi",
    "Pakistani",
    "Nepalese",
    "Laotian",
    "Taiwanese",
    "Thai",
    "Sri Lankan",
    "Burmese",
    "Okinawan",
    "Cambodian",
    "Bhutanese",
    "Singaporean",
    "Hmong",
    "Malaysian",
    "Indonesian",
)
PACIFIC_TEXTS = ("Pacific", "Polynesian", "Native Hawaiian", "Micronesian", "Melanesian")

# (column, test, texts, label)
RACE_RULES = (
    (ETHNICITY, "equals", ("Hispanic or Latino",), HISPANIC),
    (RACE, "contains", ("Hispanic",), HISPANIC),
    (RACE, "contains", ("Black",), BLACK),
    (RACE, "equals", ("African American",), BLACK),
    (RACE, "contains", ("White",), WHITE),
    (RACE, "equals", ("Asian or Pacific Islander",), "Unknown"),
    (RACE, "contains", ("Asian Indian",), "Asian Indian"),
    (RACE, "contains", ASIAN_TEXTS, ASIAN),
    (RACE, "contains", PACIFIC_TEXTS, PACIFIC),
)
# The older rules have no group of their own for Asian Indian and one for others.
RACE_RULES_OLDER = tuple(rule for rule in RACE_RULES if rule[3] != "Asian Indian") + (
    (RACE, "contains", ("Other", "Multiple", "More"), OTHER),
)


def birth_date(year: str, month: str, day: str) -> Column:
    """Date from its parts, a missing part taken as 1.

    The parts are read as text, so what is no date (30 February, the year 1)
    is null.
    """
    parts = [F.coalesce(F.col(c), F.lit(1)) for c in (year, month, day)]
    return F.try_to_date(F.concat_ws("-", *parts))


def full_years(at: str, born: str) -> Column:
    """Completed years between two dates."""
    return F.floor(F.months_between(F.col(at), F.col(born), roundOff=False) / 12)


def gender_label(name: str) -> Column:
    """MALE or FEMALE in any case, anything else UNKNOWN."""
    text = F.upper(F.col(name))
    return F.when(text.isin("MALE", "FEMALE"), text).otherwise(NO_LABEL)


def label_by_rules(rules, otherwise: str = NO_LABEL) -> Column:
    """Label of the first rule that holds."""
    label = None
    for column, test, texts, name in rules:
        if test == "equals":
            holds = F.col(column).isin(*texts)
        else:
            holds = F.lit(False)
            for text in texts:
                holds = holds | F.col(column).contains(text)
        label = F.when(holds, name) if label is None else label.when(holds, name)
    return label.otherwise(otherwise)


def five_digit_zip(raw: str) -> Column:
    """First five characters of the trimmed text where they are digits."""
    head = F.substring(F.trim(F.col(raw)), 1, 5)
    return F.when(head.rlike("^[0-9]{5}$"), head)
