"""How even tasks stay when one person and one monitor hold a third of all rows.

python tests/skew_trial.py [ROWS]

Writes tables to a new folder under /tmp, runs the operators with broadcasts
off, and prints for each long stage the median and the longest task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortair.operators import air, checks, cohort, conditions, joins, visits  # noqa: E402
from cohortair.settings import NO2  # noqa: E402
from cohortair.sources.session import tune  # noqa: E402
from cohortair.sources.tables import publish  # noqa: E402


def third(seed: int, hot, other):
    return F.when(F.rand(seed) < 0.34, hot).otherwise(other)


def make_tables(spark, folder: str, rows: int) -> dict:
    people = rows // 30
    first = F.to_date(F.lit("2015-01-01"))
    day = F.date_add(first, (F.rand(6) * 2000).cast("int"))
    stay = F.col("id") % 2 == 0
    visit = spark.range(0, rows, 1, 32).select(
        third(3, 0, (F.rand(1) * people).cast("long")).alias("person_id"),
        F.lit(1).alias("data_partner_id"),
        F.col("id").alias("visit_occurrence_id"),
        (F.rand(5) * 50).cast("int").alias("visit_concept_id"),
        day.alias("visit_start_date"),
        F.when(stay, F.col("id")).alias("macrovisit_id"),
    ).withColumn(
        "macrovisit_start_date", F.when(F.col("macrovisit_id").isNotNull(), F.col("visit_start_date"))
    ).withColumn(
        "macrovisit_end_date",
        F.date_add("macrovisit_start_date", (F.col("visit_occurrence_id") % 9).cast("int")),
    )
    dates = spark.range(0, rows // 6, 1, 8).select(
        third(8, 0, (F.rand(9) * people).cast("long")).alias("person_id"), day.alias("covid_date")
    )
    condition = spark.range(0, rows, 1, 32).select(
        third(3, 0, (F.rand(1) * people).cast("long")).alias("person_id"),
        day.alias("condition_start_date"),
        (F.rand(5) * 50).cast("int").alias("condition_concept_id"),
        F.col("id").alias("condition_occurrence_id"),
    )
    reading = spark.range(0, rows, 1, 32).select(
        third(3, 0, (F.rand(1) * 2000).cast("long")).alias("aqs_site_id"),
        third(4, first, day).alias("DateLocal"),
        (F.rand(7) * 10).alias("ArithmeticMean"),
        F.lit("1 HOUR").alias("SampleDuration"),
        (F.rand(8) * 24).cast("int").alias("ObservationCount"),
    )
    placed = spark.range(0, rows // 2, 1, 16).select(
        F.col("id").alias("person_id"), third(1, None, (F.rand(2) * 100000).cast("long")).alias("location_id")
    )
    made = {"visit": visit, "dates": dates, "condition": condition, "reading": reading, "placed": placed}
    return {name: publish(df, name, folder) for name, df in made.items()}


def stage_lines(log: str) -> list[str]:
    group, tasks = {}, {}
    with open(log) as events:
        for event in map(json.loads, events):
            if event["Event"] == "SparkListenerJobStart":
                name = (event.get("Properties") or {}).get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    group.setdefault(stage, name)
            elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
                info = event["Task Info"]
                tasks.setdefault(event["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    lines = []
    for stage, times in sorted(tasks.items()):
        times.sort()
        if group.get(stage) and times[-1] > 400:
            lines.append(
                f"{group[stage]}: {len(times)} tasks, median {times[len(times) // 2]} ms, "
                f"longest {times[-1]} ms"
            )
    return lines


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    folder = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    spark = tune(
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", folder)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4MB")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = make_tables(spark, f"{folder}/tables", rows)
    patients = (
        t["dates"].groupBy("person_id").agg(F.min("covid_date").alias("first_pos_pcr_antigen_date"))
        .withColumn("first_poslab_or_diagnosis_date", F.col("first_pos_pcr_antigen_date"))
    )
    codes = spark.range(10).select(
        F.col("id").alias("concept_id"), F.concat(F.lit("c"), F.col("id")).alias("column_name")
    )
    location = spark.range(100000).select(F.col("id").alias("location_id"), F.lit("x").alias("city"))
    merged = visits.merge_first_visits(patients, visits.associated_stays(t["visit"], patients))
    trials = {
        "flag_stays": visits.flag_stays(
            visits.cohort_stays(visits.cohort_visits(t["visit"], t["dates"])), t["dates"]
        ),
        "first_covid_stay": visits.first_covid_stay(patients, t["visit"]),
        "associated_er_visits": visits.associated_er_visits(t["visit"], patients, codes),
        "later_stays": visits.later_stays(merged, t["visit"]),
        "first_conditions_wide": conditions.first_conditions_wide(
            patients, t["condition"], codes, [f"c{i}" for i in range(10)]
        ),
        "days_since_previous": cohort.days_since_previous(t["dates"]),
        "daily_series": air.daily_series(t["reading"], NO2),
        "max_count_check": checks.max_count_check(t["reading"]),
        "attach": joins.attach(t["placed"], location, "location_id"),
    }
    for name, df in trials.items():
        spark.sparkContext.setJobGroup(name, name)
        start = time.time()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name} {time.time() - start:.1f}s", flush=True)
    spark.stop()
    print("\n".join(stage_lines(next(p for p in glob.glob(f"{folder}/*") if os.path.isfile(p)))))


if __name__ == "__main__":
    main()
