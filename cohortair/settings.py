"""Settings that name code sets, index columns and pollutants."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CodeSetNames:
    """Names of the four code sets a base cohort is built from.

    The names are data of the site that keeps the code lists, so two of them
    have no default.
    """

    antibody: str
    diagnosis: str
    # Names of the two shared code sets.
    pcr_antigen: str = "ATLAS SARS-CoV-2 rt-PCR and AG"
    positive_result: str = "ResultPos"


# Labels of the event kinds.
PCR_ANTIGEN_LABEL = "PCR or Antigen Test"
ANTIBODY_LABEL = "Antibody Test"
DIAGNOSIS_LABEL = "Condition Diagnosis"
OTHER_DIAGNOSIS_LABEL = "Other Condition"

# Columns of the area table that hold percentages as text.
AREA_MEASURES = (
    "African_American",
    "AIAN",
    "Asian",
    "NHPI",
    "White",
    "other_race",
    "two_or_more_races",
    "Hispanic_any_race",
    "male",
    "female",
    "age_18_and_under",
    "age_18_and_over",
    "age_65plus",
)

LAB_INDEX = "first_pos_pcr_antigen_date"
LAB_OR_DIAGNOSIS_INDEX = "first_poslab_or_diagnosis_date"


@dataclass(frozen=True)
class Duration:
    """One sample duration of a pollutant and the columns made from it."""

    label: str
    value: str
    used: str
    counted: str
    needs_count: int | None = None


@dataclass(frozen=True)
class Pollutant:
    """How one pollutant is selected, reduced to a day and rolled up."""

    name: str
    code: int
    keep: tuple[str, ...] | None = None
    durations: tuple[Duration, ...] = ()
    value: str = "measurement"
    # "best": highest observation count wins; "each": every reading counts.
    within_day: str = "best"
    # "first": first duration with a value; "mean": mean over the durations.
    between: str = "first"
    limit: float = 0.0
    # "values": monitors with a value; "flags": sum of the duration flags;
    # "rows": every site row of the day.
    monitors: str = "values"
    dedupe: bool = True
    area_value: str = "measurement_avg"
    labelled: bool = True


# Parameter codes and sample durations of the monitor network.
NO2 = Pollutant("NO2", 42602, keep=("1 HOUR",))
OZONE = Pollutant("ozone", 44201, keep=("8-HR RUN AVG BEGIN HOUR",))
SO2 = Pollutant(
    "SO2",
    42401,
    keep=("1 HOUR", "3-HR BLK AVG"),
    durations=(
        Duration("1 HOUR", "measurement_dur01", "measurement_01hr", "num_01hr_obs"),
        Duration(
            "3-HR BLK AVG", "measurement_dur03blk", "measurement_03hrblk", "num_03hrblk_obs"
        ),
    ),
    value="measurement_monitor_day",
    monitors="flags",
)
PM25 = Pollutant(
    "PM2.5",
    88101,
    durations=(
        Duration("24 HOUR", "measurement_dur24", "measurement_24hr", "num_24hr_obs"),
        Duration(
            "24-HR BLK AVG",
            "measurement_dur24blk",
            "measurement_24hr_blk_avg",
            "num_24hrblk_obs",
        ),
        Duration("1 HOUR", "measurement_dur1", "measurement_01hr", "num_01hr_obs", 24),
    ),
    value="measurement_avg",
    within_day="each",
    dedupe=False,
)
# The older PM2.5 rules. Its trailing means mixed all ZIPs; ours never do.
PM25_OLDER = replace(
    PM25,
    limit=0.00001,
    between="mean",
    monitors="rows",
    area_value="pm25_meas_avg",
    labelled=False,
)
