"""DuckDB text that gives the same rows as each query.

`TABLES` are the study tables of `standins.py` as common table expressions;
`ORACLES` are the queries. `oracle(name)` puts the tables a query needs in
front of it.
"""

from __future__ import annotations

import re

from cohortair.functions.demographics import ASIAN_TEXTS, PACIFIC_TEXTS
from cohortair.settings import AREA_MEASURES, NO2, OZONE, PM25, SO2
from workload.standins import RACES, READINGS

def _by_pollutant(choices: dict) -> str:
    """A CASE over the part types of each pollutant."""
    listed = "".join(
        f" WHEN p_type IN ({', '.join(map(repr, READINGS[kind][0]))}) THEN {value}"
        for kind, value in choices.items()
    )
    return f"CASE{listed} END"


def _duration(labels: tuple) -> str:
    return f"CASE l_returnflag WHEN 'A' THEN '{labels[0]}' WHEN 'N' THEN '{labels[1]}' ELSE '{labels[2]}' END"


def _of(kind) -> str:
    """Readings of one pollutant and its durations."""
    kept = f" AND SampleDuration IN ({', '.join(map(repr, kind.keep))})" if kind.keep else ""
    return f"SELECT * FROM s_readings WHERE ParameterCode = {kind.code}{kept}"


def _valid(readings: str, limit: str = "0") -> str:
    return f"""
    SELECT aqs_site_id, DateLocal, SampleDuration, ObservationCount, MethodCode, MethodName,
           ParameterName, ParameterCode, UnitsofMeasure,
           CASE WHEN NOT ArithmeticMean < {limit} THEN ArithmeticMean END AS ArithmeticMean
    FROM {readings}"""


def _best(valid: str) -> str:
    return f"""
    SELECT aqs_site_id, DateLocal AS date, avg(ArithmeticMean) AS measurement
    FROM (SELECT *, max(ObservationCount) OVER (PARTITION BY aqs_site_id, DateLocal) AS top FROM {valid})
    WHERE ObservationCount = top GROUP BY ALL"""


def _calendar(daily: str, columns: str) -> str:
    return f"""
    SELECT c.aqs_site_id, c.date, {columns}
    FROM (SELECT aqs_site_id,
                 CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
          FROM {daily} GROUP BY aqs_site_id) c
    LEFT JOIN {daily} d ON c.aqs_site_id = d.aqs_site_id AND c.date = d.date"""


def _full_years(index_date: str) -> str:
    i, b = index_date, "date_of_birth"
    return f"""CAST(floor((
        (year({i}) - year({b})) * 12 + month({i}) - month({b})
        + CASE WHEN day({i}) = day({b})
                 OR ({i} = last_day({i}) AND {b} = last_day({b})) THEN 0
               ELSE (day({i}) - day({b})) / 31.0 END) / 12) AS BIGINT)"""


def _race(older: bool) -> str:
    indian = "" if older else "WHEN contains(race_concept_name, 'Asian Indian') THEN 'Asian Indian'"
    other = (
        "WHEN regexp_matches(race_concept_name, 'Other|Multiple|More') THEN 'Other Non-Hispanic'"
        if older
        else ""
    )
    return f"""CASE
        WHEN ethnicity_concept_name = 'Hispanic or Latino' OR contains(race_concept_name, 'Hispanic')
            THEN 'Hispanic or Latino Any Race'
        WHEN contains(race_concept_name, 'Black') OR race_concept_name = 'African American'
            THEN 'Black or African American Non-Hispanic'
        WHEN contains(race_concept_name, 'White') THEN 'White Non-Hispanic'
        WHEN race_concept_name = 'Asian or Pacific Islander' THEN 'Unknown'
        {indian}
        WHEN regexp_matches(race_concept_name, '{"|".join(ASIAN_TEXTS)}') THEN 'Asian Non-Hispanic'
        WHEN regexp_matches(race_concept_name, '{"|".join(PACIFIC_TEXTS)}')
            THEN 'Native Hawaiian or Other Pacific Islander Non-Hispanic'
        {other}
        ELSE 'UNKNOWN' END"""


def _gender() -> str:
    return """CASE WHEN lower(gender_concept_name) = 'male' THEN 'MALE'
        WHEN lower(gender_concept_name) = 'female' THEN 'FEMALE' ELSE 'UNKNOWN' END"""


def _zip(column: str = "zip") -> str:
    return f"""CASE WHEN regexp_matches(trim({column}), '^[0-9]{{5}}') THEN left(trim({column}), 5) END"""


BORN = """CASE WHEN year_of_birth IS NOT NULL THEN TRY_CAST(printf('%04d-%02d-%02d', year_of_birth,
    coalesce(month_of_birth, 1), coalesce(day_of_birth, 1)) AS DATE) END"""


def _single(value: str) -> str:
    """The double nearest in single precision, as the queries give it."""
    return f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"


def _trailing(source: str, site: str, value: str) -> str:
    back = "RANGE BETWEEN INTERVAL {} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"
    over = f"OVER (PARTITION BY {site} ORDER BY date {{}})"
    parts = []
    for n in (30, 365):
        frame = over.format(back.format(n))
        mean = _single(f"avg({value}) {frame}")
        parts.append(f"{mean} AS prev_{n}_day_avg")
        parts.append(f"count({value}) {frame} AS prev_{n}_days_w_obs")
    return f"SELECT *, {', '.join(parts)} FROM {source}"


def _zip_series(
    daily: str, nearby: str, value: str, monitors: str, counts: dict, counted: str, out: str
) -> str:
    """`counted` are the readings that count; a ZIP has the smallest label of its monitors'."""
    sums = "".join(f", CAST(sum({c}) AS BIGINT) AS {n}" for c, n in counts.items())
    names = "".join(f", {n}" for n in counts.values())
    series = _trailing(
        f"""(SELECT zip_code, date, avg({value}) AS v, {monitors} AS num_monitors{sums}
             FROM {daily} JOIN {nearby} USING (aqs_site_id) GROUP BY zip_code, date)""",
        "zip_code",
        "v",
    )
    told, labels = "", ""
    if counted:
        told = "ParameterName, ParameterCode, UnitsofMeasure,"
        labels = f"""JOIN (SELECT DISTINCT ON (zip_code) zip_code, ParameterName, ParameterCode, UnitsofMeasure
            FROM ({counted}) JOIN {nearby} USING (aqs_site_id)
            ORDER BY zip_code, ParameterName, ParameterCode, UnitsofMeasure) USING (zip_code)"""
    return f"""SELECT zip_code, date AS meas_date, {told} {_single("v")} AS {out}, num_monitors{names},
        prev_30_day_avg, prev_30_days_w_obs, prev_365_day_avg, prev_365_days_w_obs
        FROM ({series}) {labels}"""


DURATIONS_PM25 = (
    ("24 HOUR", "measurement_dur24"),
    ("24-HR BLK AVG", "measurement_dur24blk"),
    ("1 HOUR", "measurement_dur1"),
)


def _pm25_daily(valid: str) -> str:
    per = [
        f"""(SELECT aqs_site_id, DateLocal AS date, avg(ArithmeticMean) AS {c} FROM {valid}
             WHERE SampleDuration = '{label}' {"AND ObservationCount = 24" if label == "1 HOUR" else ""}
             GROUP BY ALL)"""
        for label, c in DURATIONS_PM25
    ]
    return f"""SELECT * FROM {per[0]} FULL JOIN {per[1]} USING (aqs_site_id, date)
               FULL JOIN {per[2]} USING (aqs_site_id, date)"""


TABLES = {
    "s_members": """
    SELECT p_partkey AS concept_id, p_type AS concept_set_name,
           CASE WHEN p_size > 5 THEN 'true' ELSE 'false' END AS is_most_recent_version,
           CASE WHEN p_brand <> 'Brand#7' THEN p_size END AS version
    FROM part""",
    "s_codes": """
    SELECT * FROM s_members WHERE is_most_recent_version = 'true' AND version IS NOT NULL""",
    "s_rules": """
    SELECT DISTINCT p_type AS concept_set_name, lower(p_type) AS column_name,
           CASE WHEN p_type = 'SMALL' THEN 'visit_occurrence'
                ELSE 'condition_occurrence, observation' END AS domain,
           CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 0 ELSE 1 END AS comorbidity,
           CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS er_only_visit
    FROM part""",
    "s_measurement": """
    SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS measurement_date,
           l_partkey AS measurement_concept_id, l_suppkey AS value_as_concept_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "s_conditions": """
    SELECT o_custkey AS person_id,
           CASE WHEN l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS condition_start_date,
           l_partkey AS condition_concept_id,
           l_orderkey * 10 + l_linenumber AS condition_occurrence_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "s_labs": """
    SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS measurement_date,
           o_orderpriority AS concept_set_name
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "s_diagnoses": """
    SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS condition_start_date,
           o_orderpriority AS concept_set_name
    FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
    "s_person": f"""
    SELECT c_custkey AS person_id,
           CASE WHEN c_nationkey <> 7
                THEN ((CAST(floor(c_acctbal) AS INT) % 101) + 101) % 101 + 1900 END AS year_of_birth,
           CASE WHEN c_nationkey <> 8
                THEN ((CAST(floor(c_acctbal) AS INT) % 12) + 12) % 12 + 1 END AS month_of_birth,
           CASE WHEN c_nationkey <> 9
                THEN ((CAST(floor(c_acctbal) AS INT) % 31) + 31) % 31 + 1 END AS day_of_birth,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'Hispanic or Latino'
                WHEN c_mktsegment <> 'FURNITURE' THEN 'Not Hispanic or Latino' END
               AS ethnicity_concept_name,
           CASE WHEN c_nationkey <> 24 THEN
               ({list(RACES)!r})[c_nationkey + 1] END AS race_concept_name,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'Male' WHEN 'AUTOMOBILE' THEN 'FEMALE'
               WHEN 'HOUSEHOLD' THEN 'female' WHEN 'FURNITURE' THEN 'Ambiguous' END
               AS gender_concept_name,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS location_id,
           c_nationkey % 6 AS data_partner_id
    FROM customer""",
    "s_location": """
    SELECT n_nationkey AS location_id, 'City of ' || n_name AS city, 'S' || n_regionkey AS state,
           CASE WHEN n_regionkey = 0 THEN '  ' || (n_nationkey + 10001) || ' '
                WHEN n_regionkey = 1 THEN (n_nationkey + 10001) || '-1234'
                WHEN n_nationkey = 2 THEN '1000'
                WHEN n_nationkey = 3 THEN '1000x9'
                ELSE CAST(n_nationkey + 10001 AS VARCHAR) END AS zip,
           n_name AS county
    FROM nation""",
    "s_manifest": """
    SELECT r_regionkey AS data_partner_id, DATE '2022-06-01' AS run_date, r_name AS cdm_name,
           '5.3' AS cdm_version, CASE WHEN r_regionkey < 3 THEN 'N' ELSE 'Y' END AS shift_date_yn,
           r_regionkey * 7 AS max_num_shift_days
    FROM region""",
    "s_stays": """
    SELECT l_orderkey AS macrovisit_id, CAST(min(l_shipdate) AS DATE) AS macrovisit_start_date,
           CAST(max(l_shipdate) AS DATE) AS macrovisit_end_date
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey""",
    "s_visits": """
    SELECT o_custkey AS person_id, CAST(left(o_orderpriority, 1) AS INT) AS data_partner_id,
           l_orderkey * 10 + l_linenumber AS visit_occurrence_id, l_partkey AS visit_concept_id,
           l_returnflag AS visit_concept_name, CAST(l_shipdate AS DATE) AS visit_start_date,
           CAST(l_shipdate AS DATE) + l_linenumber AS visit_end_date,
           macrovisit_id, macrovisit_start_date, macrovisit_end_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN s_stays ON l_linestatus = 'F' AND macrovisit_id = l_orderkey""",
    "s_death": """
    SELECT o_custkey AS person_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS death_date,
           o_orderpriority AS cause
    FROM orders WHERE o_orderstatus = 'F'""",
    "s_area": "SELECT CAST(n_regionkey + 90001 AS VARCHAR) AS ZCTA, "
    + ", ".join(
        f"""CASE WHEN sum(CASE WHEN (length(c_name) + c_nationkey) % 13 = {i} THEN 1 ELSE 0 END) > 0
            THEN CAST(sum(CASE WHEN (length(c_name) + c_nationkey) % 13 = {i} THEN 1 ELSE 0 END)
                 AS VARCHAR) ELSE 'n/a' END AS {name}"""
        for i, name in enumerate(AREA_MEASURES)
    )
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey",
    "s_crosswalk": """
    SELECT CASE WHEN n_name = 'NATION_4' THEN '99999' ELSE CAST(n_nationkey + 10001 AS VARCHAR) END
               AS ZIP_CODE, n_name AS PO_NAME, CAST(n_regionkey + 90001 AS VARCHAR) AS ZCTA
    FROM nation""",
    "s_update": """
    SELECT CAST(n_nationkey + 10001 AS VARCHAR) AS ZIP_CODE, n_name AS PO_NAME,
           CASE WHEN r_name = 'EUROPE' THEN '90001' ELSE CAST(n_regionkey + 90001 AS VARCHAR) END AS ZCTA
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'EUROPE')""",
    "s_zip_zcta": """
    SELECT ZIP_CODE, ZCTA FROM s_crosswalk UNION SELECT ZIP_CODE, ZCTA FROM s_update""",
    "s_pairs": """
    SELECT CAST(n_regionkey + 90001 AS VARCHAR) AS zcta, s_suppkey AS aqs_site_id,
           CAST(floor(abs(s_acctbal)) AS BIGINT) AS Distance_m,
           CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS WithinZCTA
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "s_people": """
    SELECT c_custkey AS person_id,
           CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey + 10001 AS VARCHAR) END AS zip_code,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' ELSE 'N' END AS shift_date_yn,
           first_pos_pcr_antigen_date
    FROM customer JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_pos_pcr_antigen_date
                        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
         ON o_custkey = c_custkey""",
    "s_nearby": """
    SELECT DISTINCT z.zip_code, x.ZCTA AS zcta, p.aqs_site_id, p.Distance_m, p.WithinZCTA
    FROM (SELECT DISTINCT zip_code FROM s_people) z
    JOIN s_zip_zcta x ON x.ZIP_CODE = z.zip_code JOIN s_pairs p ON p.zcta = x.ZCTA""",
    "s_nearby_all": """
    SELECT z.zip_code, x.ZCTA AS zcta, p.aqs_site_id, p.Distance_m, p.WithinZCTA
    FROM (SELECT DISTINCT zip_code FROM s_people) z
    JOIN s_zip_zcta x ON x.ZIP_CODE = z.zip_code JOIN s_pairs p ON p.zcta = x.ZCTA""",
    "s_climate_1": """
    SELECT CASE c_nationkey WHEN 11 THEN '99999' ELSE CAST(c_nationkey + 10001 AS VARCHAR) END AS POSTCODE,
           CAST(o_orderdate AS DATE) AS Date,
           CAST(count(*) AS DOUBLE) AS MeanTemp, CAST(max(o_custkey) AS DOUBLE) AS Precip,
           CAST(min(CASE WHEN o_orderpriority < '4' THEN o_custkey END) AS DOUBLE) AS DewPoint
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F'
    GROUP BY c_nationkey, CAST(o_orderdate AS DATE)""",
    "s_climate_2": """
    SELECT CASE c_nationkey WHEN 11 THEN '99999' ELSE CAST(c_nationkey + 10001 AS VARCHAR) END AS POSTCODE,
           CAST(o_orderdate AS DATE) AS Date,
           CAST(count(*) AS DOUBLE) AS MeanTemp, CAST(max(o_custkey) AS DOUBLE) AS Precip,
           CAST(min(CASE WHEN o_orderpriority < '4' THEN o_custkey END) AS DOUBLE) AS DewPoint
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus <> 'F'
    GROUP BY c_nationkey, CAST(o_orderdate AS DATE)""",
    "s_climate": "SELECT * FROM s_climate_1 UNION ALL SELECT * FROM s_climate_2",
    "s_readings": f"""
    SELECT l_suppkey AS aqs_site_id, CAST(l_shipdate AS DATE) AS DateLocal,
           round(l_discount * 100) - 2 AS ArithmeticMean,
           CASE WHEN l_linenumber > 5 THEN 'ppb' ELSE 'Parts per billion' END AS UnitsofMeasure,
           {_by_pollutant({k: _duration(v[1]) for k, v in READINGS.items()})} AS SampleDuration,
           CASE WHEN l_tax > 0 THEN CASE WHEN l_linenumber > 4 THEN 24 ELSE l_linenumber END END
               AS ObservationCount,
           {_by_pollutant({k: k.code for k in READINGS})} AS ParameterCode,
           {_by_pollutant({k: repr(k.name) for k in READINGS})}
               || CASE WHEN l_linenumber > 3 THEN ' (local)' ELSE '' END AS ParameterName,
           p_brand AS CityName, 'State' AS StateName, CAST(0 AS DOUBLE) AS Latitude,
           CAST(0 AS DOUBLE) AS Longitude, l_linenumber AS MethodCode,
           'method ' || l_linenumber AS MethodName
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "s_no2": _of(NO2),
    "s_ozone": _of(OZONE),
    "s_so2": _of(SO2),
    "s_pm25": _of(PM25),
    "s_ozone_valid": _valid("s_ozone"),
    "s_no2_valid": _valid("s_no2"),
    "s_so2_valid": _valid("s_so2"),
    "s_pm25_valid": _valid("s_pm25"),
    "s_pm25_valid_older": _valid("s_pm25", "0.00001"),
    "s_best": _best("s_no2_valid"),
    "s_best_daily": _calendar("s_best", "d.measurement"),
    "s_ozone_best": _best("s_ozone_valid"),
    "s_ozone_daily": _calendar("s_ozone_best", "d.measurement"),
    "s_so2_best": """
    SELECT aqs_site_id, DateLocal, SampleDuration, avg(ArithmeticMean) AS m
    FROM (SELECT *, max(ObservationCount) OVER
                 (PARTITION BY aqs_site_id, DateLocal, SampleDuration) AS top FROM s_so2_valid)
    WHERE ObservationCount = top GROUP BY ALL""",
    "s_so2_merged": """
    SELECT aqs_site_id, date, measurement_dur01, measurement_dur03blk
    FROM (SELECT aqs_site_id, DateLocal AS date, m AS measurement_dur01 FROM s_so2_best
          WHERE SampleDuration = '1 HOUR')
    FULL JOIN (SELECT aqs_site_id, DateLocal AS date, m AS measurement_dur03blk FROM s_so2_best
          WHERE SampleDuration = '3-HR BLK AVG') USING (aqs_site_id, date)""",
    "s_so2_daily": """
    SELECT *, coalesce(measurement_dur01, measurement_dur03blk) AS measurement_monitor_day,
           CASE WHEN measurement_dur01 IS NOT NULL THEN 1 ELSE 0 END AS measurement_01hr,
           CASE WHEN measurement_dur01 IS NULL AND measurement_dur03blk IS NOT NULL THEN 1 ELSE 0 END
               AS measurement_03hrblk
    FROM (""" + _calendar("s_so2_merged", "measurement_dur01, measurement_dur03blk") + ")",
    "s_pm25_merged": _pm25_daily("s_pm25_valid"),
    "s_pm25_daily": """
    SELECT *, coalesce(measurement_dur24, measurement_dur24blk, measurement_dur1) AS measurement_avg,
           CASE WHEN measurement_dur24 IS NOT NULL THEN 1 ELSE 0 END AS measurement_24hr,
           CASE WHEN measurement_dur24 IS NULL AND measurement_dur24blk IS NOT NULL THEN 1 ELSE 0 END
               AS measurement_24hr_blk_avg,
           CASE WHEN measurement_dur24 IS NULL AND measurement_dur24blk IS NULL
                     AND measurement_dur1 IS NOT NULL THEN 1 ELSE 0 END AS measurement_01hr
    FROM ("""
    + _calendar("s_pm25_merged", "measurement_dur24, measurement_dur24blk, measurement_dur1")
    + ")",
    "s_pm25_merged_older": _pm25_daily("s_pm25_valid_older"),
    "s_pm25_daily_older": """
    SELECT *, list_avg(list_filter([measurement_dur24, measurement_dur24blk, measurement_dur1],
                                   lambda x: x IS NOT NULL)) AS measurement_avg,
           CASE WHEN measurement_dur24 IS NOT NULL THEN 1 ELSE 0 END AS measurement_24hr,
           CASE WHEN measurement_dur24blk IS NOT NULL THEN 1 ELSE 0 END AS measurement_24hr_blk_avg,
           CASE WHEN measurement_dur1 IS NOT NULL THEN 1 ELSE 0 END AS measurement_01hr
    FROM ("""
    + _calendar("s_pm25_merged_older", "measurement_dur24, measurement_dur24blk, measurement_dur1")
    + ")",
    # Results that later queries build on.
    "r_first": """
    SELECT person_id, min(measurement_date) AS first_pos_pcr_antigen_date
    FROM s_labs WHERE concept_set_name = '1-URGENT' GROUP BY person_id""",
    "r_all": """
    SELECT person_id,
           CASE WHEN first_antigen_or_poslab_or_diagnosis_date = first_pos_pcr_antigen_date
                    THEN 'PCR or Antigen Test'
                WHEN first_antigen_or_poslab_or_diagnosis_date = first_pos_diagnosis_date
                    THEN 'Condition Diagnosis'
                ELSE 'Antibody Test' END AS covid_event_type,
           first_pos_pcr_antigen_date, first_pos_diagnosis_date, first_pos_antibody_date,
           first_poslab_or_diagnosis_date, first_antigen_or_poslab_or_diagnosis_date
    FROM (SELECT *, least(first_pos_pcr_antigen_date, first_pos_diagnosis_date)
                        AS first_poslab_or_diagnosis_date,
                 least(first_pos_pcr_antigen_date, first_pos_antibody_date, first_pos_diagnosis_date)
                        AS first_antigen_or_poslab_or_diagnosis_date
          FROM (SELECT person_id, min(measurement_date) AS first_pos_pcr_antigen_date FROM s_labs
                WHERE concept_set_name = '1-URGENT' GROUP BY person_id)
          FULL JOIN (SELECT person_id, min(measurement_date) AS first_pos_antibody_date FROM s_labs
                WHERE concept_set_name <> '1-URGENT' GROUP BY person_id) USING (person_id)
          FULL JOIN (SELECT person_id, min(condition_start_date) AS first_pos_diagnosis_date
                FROM s_diagnoses WHERE concept_set_name = '3-MEDIUM' GROUP BY person_id)
                USING (person_id))""",
    "r_dates": """
    SELECT DISTINCT person_id, measurement_date AS covid_date FROM s_labs
    WHERE concept_set_name = '1-URGENT'""",
    "r_located": """
    SELECT f.*, p.* EXCLUDE (person_id, location_id, data_partner_id), p.location_id,
           p.data_partner_id, l.city, l.state, l.zip, l.county,
           m.run_date, m.cdm_name, m.cdm_version, m.shift_date_yn, m.max_num_shift_days
    FROM r_first f LEFT JOIN s_person p ON p.person_id = f.person_id
    LEFT JOIN s_location l ON l.location_id = p.location_id
    LEFT JOIN s_manifest m ON m.data_partner_id = p.data_partner_id""",
    "r_located_older": """
    SELECT f.* EXCLUDE (first_antigen_or_poslab_or_diagnosis_date),
           p.* EXCLUDE (person_id, location_id, data_partner_id), p.location_id,
           p.data_partner_id, l.city, l.state, l.zip, l.county,
           m.run_date, m.cdm_name, m.cdm_version, m.shift_date_yn, m.max_num_shift_days
    FROM r_all f LEFT JOIN s_person p ON p.person_id = f.person_id
    LEFT JOIN s_location l ON l.location_id = p.location_id
    LEFT JOIN s_manifest m ON m.data_partner_id = p.data_partner_id
    WHERE f.first_poslab_or_diagnosis_date IS NOT NULL""",
    "r_condition_codes": """
    SELECT concept_id, column_name FROM s_members JOIN s_rules USING (concept_set_name)
    WHERE is_most_recent_version = 'true' AND contains(domain, 'condition_occurrence')
      AND comorbidity = 1""",
    "r_coded": """
    SELECT person_id, condition_start_date, condition_occurrence_id, column_name
    FROM s_conditions JOIN r_condition_codes ON concept_id = condition_concept_id
    WHERE condition_start_date IS NOT NULL AND person_id IN (SELECT person_id FROM r_first)""",
    "r_flags": """
    SELECT person_id, condition_start_date AS comorbidity_start_date, """
    + ", ".join(
        f"max(CASE WHEN column_name = '{c}' THEN 1 ELSE 0 END) AS {c}"
        for c in ("standard", "promo", "economy", "large")
    )
    + " FROM r_coded GROUP BY person_id, condition_start_date",
    "r_er_codes": """
    SELECT concept_id FROM s_members WHERE is_most_recent_version = 'true'
      AND concept_set_name IN (SELECT concept_set_name FROM s_rules WHERE er_only_visit = 1)""",
    "r_er_visits": """
    SELECT person_id, visit_start_date,
           datediff('day', visit_start_date, first_poslab_or_diagnosis_date) AS first_minus,
           datediff('day', visit_start_date, first_pos_pcr_antigen_date) AS lab_minus,
           datediff('day', first_pos_diagnosis_date, first_pos_pcr_antigen_date) AS lab_minus_diag
    FROM s_visits JOIN r_all USING (person_id)
    WHERE macrovisit_start_date IS NULL AND visit_concept_id IN (SELECT concept_id FROM r_er_codes)""",
    "r_stay_starts": """
    SELECT person_id, macrovisit_id, macrovisit_start_date, macrovisit_end_date,
           datediff('day', macrovisit_start_date, first_poslab_or_diagnosis_date) AS first_minus,
           datediff('day', macrovisit_start_date, first_pos_pcr_antigen_date) AS lab_minus,
           datediff('day', first_pos_diagnosis_date, first_pos_pcr_antigen_date) AS lab_minus_diag
    FROM s_visits JOIN r_all USING (person_id) WHERE macrovisit_start_date IS NOT NULL""",
    "r_er_either": """
    SELECT person_id, min(visit_start_date) AS first_covid_er_only_start_date FROM r_er_visits
    WHERE first_minus BETWEEN -16 AND 1 GROUP BY person_id""",
    "r_stays_either": """
    SELECT person_id, macrovisit_id,
           macrovisit_start_date AS first_COVID_hospitalization_start_date,
           macrovisit_end_date AS first_COVID_hospitalization_end_date
    FROM (SELECT *, row_number() OVER (PARTITION BY person_id
                 ORDER BY macrovisit_start_date, macrovisit_id) AS n
          FROM r_stay_starts WHERE first_minus BETWEEN -16 AND 1) WHERE n = 1""",
    "r_er_both": """
    SELECT person_id, min(visit_start_date) AS first_covid_er_only_start_date FROM r_er_visits
    WHERE lab_minus BETWEEN -16 AND 1 AND lab_minus_diag BETWEEN -16 AND 1 GROUP BY person_id""",
    "r_stays_both": """
    SELECT person_id, macrovisit_id,
           macrovisit_start_date AS first_COVID_hospitalization_start_date,
           macrovisit_end_date AS first_COVID_hospitalization_end_date
    FROM (SELECT *, row_number() OVER (PARTITION BY person_id
                 ORDER BY macrovisit_start_date, macrovisit_id) AS n
          FROM r_stay_starts
          WHERE lab_minus BETWEEN -16 AND 1 AND lab_minus_diag BETWEEN -16 AND 1) WHERE n = 1""",
    "r_study_nearby": f"""
    SELECT DISTINCT z.zip_code, x.ZCTA AS zcta, p.aqs_site_id, p.Distance_m, p.WithinZCTA
    FROM (SELECT DISTINCT {_zip()} AS zip_code FROM r_located) z
    JOIN s_zip_zcta x ON x.ZIP_CODE = z.zip_code JOIN s_pairs p ON p.zcta = x.ZCTA""",
    "r_merged": """
    SELECT * FROM r_all LEFT JOIN r_stays_either USING (person_id)""",
    "r_first_stay": """
    SELECT r_first.*, first_covid_macrovisit_id, first_covid_macrovisit_start_date,
           first_covid_macrovisit_end_date,
           CASE WHEN first_covid_macrovisit_id IS NULL THEN 0 ELSE 1 END AS covid_associated_hosp
    FROM r_first LEFT JOIN (
        SELECT person_id, macrovisit_id AS first_covid_macrovisit_id,
               macrovisit_start_date AS first_covid_macrovisit_start_date,
               macrovisit_end_date AS first_covid_macrovisit_end_date
        FROM (SELECT v.*, row_number() OVER (PARTITION BY v.person_id
                     ORDER BY macrovisit_start_date, macrovisit_id) AS n
              FROM s_visits v JOIN r_first f ON f.person_id = v.person_id
              WHERE macrovisit_id IS NOT NULL
                AND macrovisit_start_date >= first_pos_pcr_antigen_date - 1
                AND macrovisit_start_date <= first_pos_pcr_antigen_date + 16
                AND first_pos_pcr_antigen_date <= macrovisit_end_date) WHERE n = 1) s
    ON s.person_id = r_first.person_id""",
    "r_latest_death": """
    SELECT person_id, max(death_date) AS death_date FROM s_death GROUP BY person_id""",
    "r_cohort_visits": """
    SELECT * FROM s_visits WHERE person_id IN (SELECT person_id FROM r_dates)""",
    "r_climate_lag": """
    SELECT p.person_id, p.zip_code, p.first_pos_pcr_antigen_date, CAST(time_lag AS INT) AS time_lag,
           CAST(first_pos_pcr_antigen_date + CAST(time_lag AS INT) AS DATE) AS lag_dates,
           c.Date AS climate_measure_date, MeanTemp, Precip, DewPoint
    FROM s_people p CROSS JOIN (SELECT unnest(range(-45, 46)) AS time_lag)
    LEFT JOIN s_climate c ON c.POSTCODE = p.zip_code
         AND c.Date = first_pos_pcr_antigen_date + CAST(time_lag AS INT)
    WHERE p.zip_code IN (SELECT POSTCODE FROM s_climate)""",
    "r_unmatched": """
    SELECT DISTINCT zip_code FROM s_people
    WHERE zip_code IS NULL OR zip_code NOT IN (SELECT POSTCODE FROM s_climate)""",
}

PM25_COUNTS = {
    "measurement_24hr": "num_24hr_obs",
    "measurement_24hr_blk_avg": "num_24hrblk_obs",
    "measurement_01hr": "num_01hr_obs",
}
SO2_COUNTS = {"measurement_01hr": "num_01hr_obs", "measurement_03hrblk": "num_03hrblk_obs"}
DAILY_PM25_COLUMNS = (
    "aqs_site_id, date, "
    + "".join(
        f"{_single(c)} AS {c}, "
        for c in ("measurement_dur24", "measurement_dur24blk", "measurement_dur1", "measurement_avg")
    )
    + "measurement_24hr, measurement_24hr_blk_avg, measurement_01hr"
)
SELECTED = """SELECT aqs_site_id, DateLocal, ArithmeticMean, UnitsofMeasure, SampleDuration,
    ObservationCount, ParameterCode, ParameterName, CityName, StateName, Latitude, Longitude
    FROM s_readings WHERE ParameterCode = """
VISIT_COLUMNS = """person_id, macrovisit_id, visit_occurrence_id, visit_concept_id, visit_concept_name,
    visit_start_date, visit_end_date, macrovisit_start_date, macrovisit_end_date"""

def _person_fact() -> str:
    return f"""
    SELECT l.*, s.* EXCLUDE (person_id, first_pos_pcr_antigen_date), d.death_date,
           CASE WHEN d.death_date IS NULL THEN 0 ELSE 1 END AS death_recorded, date_of_birth,
           CASE WHEN a >= 0 THEN a END AS age_at_first_covid_diag, {_gender()} AS gender,
           {_race(False)} AS race_ethnicity, {_zip()} AS zip_code
    FROM r_located l
    JOIN (SELECT person_id, date_of_birth, {_full_years("first_pos_pcr_antigen_date")} AS a
          FROM (SELECT *, {BORN} AS date_of_birth FROM r_located)) b ON b.person_id = l.person_id
    JOIN r_first_stay s ON s.person_id = l.person_id
    LEFT JOIN r_latest_death d ON d.person_id = l.person_id"""


def _person_fact_older(stays: str = "r_stays_either", er: str = "r_er_either") -> str:
    told, joined = "", ""
    if er:
        told = "first_covid_er_only_start_date,"
        joined = f"LEFT JOIN {er} e ON e.person_id = l.person_id"
    return f"""
    SELECT l.*, coalesce(standard, 0) AS standard, coalesce(promo, 0) AS promo,
           coalesce(economy, 0) AS economy, coalesce(large, 0) AS large,
           macrovisit_id, first_COVID_hospitalization_start_date,
           first_COVID_hospitalization_end_date, {told} death_date, cause,
           date_of_birth, a AS age_at_first_covid_diag, {_gender()} AS gender,
           {_race(True)} AS race_ethnicity, {_zip()} AS zip_code
    FROM r_located_older l
    JOIN (SELECT person_id, date_of_birth, {_full_years("first_poslab_or_diagnosis_date")} AS a
          FROM (SELECT *, {BORN} AS date_of_birth FROM r_located_older)) b ON b.person_id = l.person_id
    LEFT JOIN (SELECT person_id, max(CASE WHEN column_name = 'standard' THEN 1 ELSE 0 END) AS standard,
                      max(CASE WHEN column_name = 'promo' THEN 1 ELSE 0 END) AS promo,
                      max(CASE WHEN column_name = 'economy' THEN 1 ELSE 0 END) AS economy,
                      max(CASE WHEN column_name = 'large' THEN 1 ELSE 0 END) AS large
               FROM s_conditions JOIN r_condition_codes ON concept_id = condition_concept_id
               WHERE condition_start_date IS NOT NULL GROUP BY person_id) f ON f.person_id = l.person_id
    LEFT JOIN {stays} s ON s.person_id = l.person_id
    {joined}
    LEFT JOIN s_death d ON d.person_id = l.person_id"""


ORACLES = {
    "code_set": "SELECT DISTINCT * FROM s_codes WHERE concept_set_name IN ('STANDARD', 'PROMO')",
    "tag_positive": """
    SELECT m.*, t.concept_set_name, t.concept_id
    FROM s_measurement m JOIN s_codes t ON t.concept_id = m.measurement_concept_id
         AND t.concept_set_name IN ('STANDARD', 'PROMO')
    JOIN s_codes r ON r.concept_id = m.value_as_concept_id AND r.concept_set_name = 'LARGE'""",
    "tag_diagnoses": """
    SELECT c.*, t.concept_set_name, t.concept_id FROM s_conditions c
    JOIN s_codes t ON t.concept_id = c.condition_concept_id AND t.concept_set_name = 'ECONOMY'""",
    "first_events": "SELECT * FROM r_first",
    "first_events_all": "SELECT * FROM r_all",
    "base_cohort": """
    SELECT person_id,
           CASE WHEN least(p, a, d) = p THEN 'PCR or Antigen Test'
                WHEN least(p, a, d) = d THEN 'Condition Diagnosis'
                WHEN least(p, a, d) = a THEN 'Antibody Test' END AS covid_event_type,
           p AS first_pos_pcr_antigen_date, d AS first_pos_diagnosis_date,
           a AS first_pos_antibody_date, least(p, d) AS first_poslab_or_diagnosis_date,
           least(p, a, d) AS first_antigen_or_poslab_or_diagnosis_date
    FROM (SELECT person_id, min(measurement_date) FILTER (t.concept_set_name = 'STANDARD') AS p,
                 min(measurement_date) FILTER (t.concept_set_name = 'PROMO') AS a
          FROM s_measurement m JOIN s_codes t ON t.concept_id = m.measurement_concept_id
               AND t.concept_set_name IN ('STANDARD', 'PROMO')
          WHERE value_as_concept_id IN
                (SELECT concept_id FROM s_codes WHERE concept_set_name = 'LARGE')
          GROUP BY person_id)
    FULL JOIN (SELECT person_id, min(condition_start_date) AS d FROM s_conditions
          WHERE condition_concept_id IN
                (SELECT concept_id FROM s_codes WHERE concept_set_name = 'ECONOMY')
          GROUP BY person_id) USING (person_id)""",
    "positive_dates_all": """
    SELECT DISTINCT person_id, measurement_date AS covid_date, concept_set_name,
           'PCR or Antigen Test' AS covid_event_type
    FROM s_labs WHERE concept_set_name = '1-URGENT'
    UNION
    SELECT person_id, condition_start_date, concept_set_name,
           CASE WHEN concept_set_name = '3-MEDIUM' THEN 'Condition Diagnosis' ELSE 'Other Condition' END
    FROM s_diagnoses""",
    "positive_dates": """
    SELECT person_id, covid_date, '1-URGENT' AS concept_set_name,
           'PCR or Antigen Test' AS covid_event_type FROM r_dates""",
    "positive_gaps": """
    SELECT person_id, covid_date, CAST(datediff('day', lag(covid_date) OVER
           (PARTITION BY person_id ORDER BY covid_date), covid_date) AS INT) AS days_since_pos_pcr_antigen
    FROM r_dates""",
    "positive_gaps_all": """
    SELECT person_id, covid_date, CAST(datediff('day', lag(covid_date) OVER
           (PARTITION BY person_id ORDER BY covid_date), covid_date) AS INT) AS days_since_pos_pcr_antigen
    FROM (SELECT person_id, covid_date FROM r_dates UNION
          SELECT person_id, condition_start_date FROM s_diagnoses)""",
    "attach_people": """
    SELECT * FROM r_first LEFT JOIN s_person USING (person_id) LEFT JOIN s_location USING (location_id)""",
    "sample_all": "SELECT * FROM r_first",
    "sample_stable": """
    SELECT * FROM r_first
    WHERE ('0x' || left(md5('111:' || person_id), 8))::BIGINT / 4294967296.0 < 0.3""",
    "attach_locations": "SELECT * FROM r_located",
    "attach_locations_older": "SELECT * FROM r_located_older",
    "age": f"""
    SELECT person_id, date_of_birth, CASE WHEN a >= 0 THEN a END AS age_at_first_covid_diag
    FROM (SELECT *, {_full_years("first_pos_pcr_antigen_date")} AS a
          FROM (SELECT *, {BORN} AS date_of_birth FROM r_first JOIN s_person USING (person_id)))""",
    "age_older": f"""
    SELECT person_id, date_of_birth,
           {_full_years("first_poslab_or_diagnosis_date")} AS age_at_first_covid_diag
    FROM (SELECT *, {BORN} AS date_of_birth FROM r_all JOIN s_person USING (person_id))""",
    "gender": f"SELECT person_id, {_gender()} AS gender FROM s_person",
    "race": f"SELECT person_id, {_race(False)} AS race_ethnicity FROM s_person",
    "race_older": f"SELECT person_id, {_race(True)} AS race_ethnicity FROM s_person",
    "clean_zip": f"""
    SELECT person_id, zip, {_zip()} AS zip_code FROM s_person LEFT JOIN s_location USING (location_id)""",
    "condition_codes": "SELECT * FROM r_condition_codes",
    "conditions_wide": "SELECT person_id, "
    + ", ".join(
        f"""max(CASE WHEN column_name = '{c}' THEN condition_start_date END) AS {c}_start,
            max(CASE WHEN column_name = '{c}' THEN condition_occurrence_id END) AS {c}_c_occ_id"""
        for c in ("standard", "promo", "economy", "large")
    )
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY person_id, column_name
                       ORDER BY condition_start_date, condition_occurrence_id) AS n FROM r_coded)
          WHERE n = 1 GROUP BY person_id""",
    "condition_flags": "SELECT * FROM r_flags",
    "condition_flags_person": "SELECT r_first.*, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("standard", "promo", "economy", "large"))
    + " FROM r_first LEFT JOIN (SELECT person_id, "
    + ", ".join(f"max({c}) AS {c}" for c in ("standard", "promo", "economy", "large"))
    + " FROM r_flags GROUP BY person_id) USING (person_id)",
    "er_codes": "SELECT * FROM r_er_codes",
    "er_first_either": "SELECT * FROM r_er_either",
    "er_first_both": """
    SELECT person_id, min(visit_start_date) AS first_covid_er_only_start_date FROM r_er_visits
    WHERE lab_minus BETWEEN -90 AND 30 AND lab_minus_diag BETWEEN -90 AND 30 GROUP BY person_id""",
    "stays_either": "SELECT * FROM r_stays_either",
    "stays_both": """
    SELECT person_id, macrovisit_id,
           macrovisit_start_date AS first_COVID_hospitalization_start_date,
           macrovisit_end_date AS first_COVID_hospitalization_end_date
    FROM (SELECT *, row_number() OVER (PARTITION BY person_id
                 ORDER BY macrovisit_start_date, macrovisit_id) AS n
          FROM r_stay_starts
          WHERE lab_minus BETWEEN -90 AND 30 AND lab_minus_diag BETWEEN -90 AND 30) WHERE n = 1""",
    "visit_merge": """
    SELECT * FROM r_all LEFT JOIN (SELECT * FROM r_stays_either FULL JOIN r_er_either USING (person_id))
    USING (person_id)""",
    "first_stay": "SELECT * FROM r_first_stay",
    "later_stays": """
    SELECT DISTINCT m.person_id, first_poslab_or_diagnosis_date, first_COVID_hospitalization_start_date,
           first_COVID_hospitalization_end_date, v.macrovisit_id, v.macrovisit_start_date,
           v.macrovisit_end_date
    FROM r_merged m JOIN s_visits v ON v.person_id = m.person_id
    WHERE v.macrovisit_id IS NOT NULL
      AND ((first_COVID_hospitalization_start_date IS NOT NULL
            AND first_COVID_hospitalization_start_date < macrovisit_start_date)
        OR (first_COVID_hospitalization_start_date IS NULL
            AND first_poslab_or_diagnosis_date < macrovisit_start_date))""",
    "last_death": """
    SELECT *, CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS death_recorded
    FROM r_first LEFT JOIN r_latest_death USING (person_id)""",
    "death_older": "SELECT * FROM r_first LEFT JOIN s_death USING (person_id)",
    "severity": """
    SELECT f.*, c_mktsegment AS Severity_Type, c_nationkey AS sev_data_partner_id,
           CASE WHEN c_custkey IS NOT NULL THEN DATE '2020-05-01' END AS sev_visit_start_date,
           c_custkey * 2 AS sev_visit_occurrence_id, CAST(c_acctbal > 5000 AS INT) AS AKI_in_hospital,
           CAST(c_acctbal > 8000 AS INT) AS ECMO, CAST(c_acctbal > 7000 AS INT) AS Invasive_Ventilation,
           CAST(floor(c_acctbal) AS BIGINT) AS Q_Score, CAST(floor(c_acctbal / 100) AS BIGINT) AS BMI,
           CASE WHEN c_custkey IS NOT NULL THEN 170 END AS Height,
           CAST(floor(c_acctbal / 90) AS BIGINT) AS Weight, left(c_mktsegment, 1) AS blood_type,
           CASE WHEN c_acctbal > 4000 THEN 'Smoker' END AS smoking_status
    FROM r_first f LEFT JOIN customer ON c_custkey = f.person_id AND c_acctbal > 0""",
    "area_by_zip": """
    SELECT s_area.*, ZIP_CODE AS zipcode FROM s_area JOIN s_crosswalk USING (ZCTA)""",
    "people_area": "SELECT p.zip_code, p.person_id, x.ZCTA, x.ZIP_CODE AS zipcode, "
    + ", ".join(f"TRY_CAST(a.{c} AS DOUBLE) AS {c}" for c in AREA_MEASURES)
    + """, d.MDs FROM s_people p LEFT JOIN s_crosswalk x ON x.ZIP_CODE = p.zip_code
         LEFT JOIN s_area a ON a.ZCTA = x.ZCTA
         LEFT JOIN (SELECT o_custkey, count(*) AS MDs FROM orders
                    WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY o_custkey) d
              ON d.o_custkey = p.person_id""",
    "unmatched_areas": f"""
    SELECT DISTINCT city, state, zip, ZCTA
    FROM (SELECT *, {_zip()} AS z FROM s_person LEFT JOIN s_location USING (location_id))
    LEFT JOIN s_crosswalk ON ZIP_CODE = z WHERE ZCTA IS NULL""",
    "zip_counts": "SELECT zip_code, count(*) AS count FROM s_people GROUP BY zip_code",
    "zip_counts_raw": """
    SELECT zip, count(*) AS count FROM s_person LEFT JOIN s_location USING (location_id) GROUP BY zip""",
    "stay_code_counts": """
    SELECT macrovisit_id, count(*) AS multi_inpatient_codes FROM s_visits
    WHERE macrovisit_id IS NOT NULL AND visit_concept_name = 'R' GROUP BY macrovisit_id""",
    "stay_detail": f"SELECT {VISIT_COLUMNS} FROM s_visits WHERE macrovisit_id = 7",
    "person_stays": f"""
    SELECT {VISIT_COLUMNS} FROM s_visits WHERE macrovisit_id IS NOT NULL AND person_id = 7""",
    "person_fact": _person_fact(),
    "person_fact_sample": f"""
    SELECT * FROM ({_person_fact()})
    WHERE ('0x' || left(md5('111:' || person_id), 8))::BIGINT / 4294967296.0 < 0.3""",
    "person_fact_older": _person_fact_older(),
    "person_fact_older_both": _person_fact_older("r_stays_both", "r_er_both"),
    "person_fact_older_no_er": _person_fact_older(er=""),
    "study_areas": f"""
    SELECT DISTINCT city, state, zip, ZCTA FROM (SELECT *, {_zip()} AS z FROM r_located)
    LEFT JOIN s_zip_zcta ON ZIP_CODE = z WHERE ZCTA IS NULL""",
    "study_air": _zip_series(
        "s_best_daily", "r_study_nearby", "measurement", "count(measurement)", {},
        "SELECT * FROM s_no2 WHERE ObservationCount IS NOT NULL", "measurement_avg",
    ),
    "publish_cohort": "SELECT * FROM r_all",
    "positive_lab_dates": """
    SELECT person_id, covid_date, '1-URGENT' AS concept_set_name,
           'PCR or Antigen Test' AS covid_event_type FROM r_dates""",
    "cohort_visits": "SELECT * FROM r_cohort_visits",
    "cohort_stays": """
    SELECT DISTINCT person_id, data_partner_id, macrovisit_id, macrovisit_start_date,
           macrovisit_end_date FROM s_visits WHERE macrovisit_id IS NOT NULL""",
    "other_visits": """
    SELECT * EXCLUDE (macrovisit_id, macrovisit_start_date, macrovisit_end_date)
    FROM s_visits WHERE macrovisit_id IS NULL""",
    "cohort_other_visits": """
    SELECT * EXCLUDE (macrovisit_id, macrovisit_start_date, macrovisit_end_date)
    FROM r_cohort_visits WHERE macrovisit_id IS NULL""",
    "flag_stays": """
    SELECT s.person_id, s.macrovisit_id, CASE WHEN h.d IS NULL THEN 0 ELSE 1 END AS covid_associated_hosp,
           h.d AS poslab_date, s.macrovisit_start_date, s.macrovisit_end_date, s.data_partner_id
    FROM (SELECT DISTINCT person_id, data_partner_id, macrovisit_id, macrovisit_start_date,
                 macrovisit_end_date FROM r_cohort_visits WHERE macrovisit_id IS NOT NULL) s
    LEFT JOIN (SELECT v.macrovisit_id, min(covid_date) AS d
               FROM r_cohort_visits v JOIN r_dates p ON p.person_id = v.person_id
               WHERE v.macrovisit_id IS NOT NULL
                 AND macrovisit_start_date >= covid_date - 1
                 AND macrovisit_start_date <= covid_date + 16
                 AND covid_date <= macrovisit_end_date GROUP BY v.macrovisit_id) h
         ON h.macrovisit_id = s.macrovisit_id""",
    "stack_years": "SELECT * FROM s_climate",
    "shared_zips": """
    SELECT DISTINCT POSTCODE FROM s_climate JOIN s_people ON zip_code = POSTCODE""",
    "climate_for_zips": """
    SELECT POSTCODE, MeanTemp, Precip, DewPoint, Date FROM s_climate
    WHERE POSTCODE IN (SELECT zip_code FROM s_people JOIN s_climate ON zip_code = POSTCODE)""",
    "people_with_climate": """
    SELECT person_id, zip_code, first_pos_pcr_antigen_date FROM s_people
    WHERE zip_code IN (SELECT POSTCODE FROM s_climate)""",
    "expand_lags": """
    SELECT s_people.*, CAST(time_lag AS INT) AS time_lag,
           CAST(first_pos_pcr_antigen_date + CAST(time_lag AS INT) AS DATE) AS lag_dates
    FROM s_people CROSS JOIN (SELECT unnest(range(-45, 46)) AS time_lag)""",
    "climate_by_lag": """
    SELECT *, CAST(dayofweek(lag_dates) + 1 AS INT) AS day_of_week_num,
           left(dayname(lag_dates), 3) AS day_of_week FROM r_climate_lag""",
    "distinct_zips": "SELECT DISTINCT zip_code FROM s_people",
    "climate_zips": "SELECT DISTINCT POSTCODE FROM s_climate",
    "unmatched_zips": """
    SELECT zip_code, CAST(row_number() OVER (ORDER BY zip_code NULLS FIRST) AS INT) AS row_num
    FROM (SELECT DISTINCT zip_code FROM s_people
          WHERE zip_code IS NULL OR zip_code NOT IN (SELECT ZIP_CODE FROM s_update))""",
    "unmatched_zips_from": """
    SELECT * FROM (SELECT zip_code, CAST(row_number() OVER (ORDER BY zip_code NULLS FIRST) AS INT) AS row_num
                   FROM r_unmatched) WHERE row_num >= 2""",
    "covered_people": """
    SELECT count(DISTINCT person_id) AS n_people FROM r_climate_lag
    WHERE MeanTemp IS NOT NULL AND DewPoint IS NOT NULL AND Precip IS NOT NULL""",
    "covered_unshifted": """
    SELECT count(DISTINCT a.person_id) AS n_people FROM s_people a
    JOIN (SELECT DISTINCT person_id FROM r_climate_lag
          WHERE MeanTemp IS NOT NULL AND DewPoint IS NOT NULL AND Precip IS NOT NULL) b
    ON a.person_id = b.person_id WHERE a.shift_date_yn = 'N'""",
    "crosswalk": "SELECT * FROM s_zip_zcta",
    "crosswalk_whole_rows": "SELECT * FROM s_update UNION ALL SELECT * FROM s_crosswalk",
    "cohort_zips": "SELECT DISTINCT zip_code FROM s_people",
    "cohort_zips_person": "SELECT zip_code FROM s_people WHERE person_id = 7",
    "zips_to_zcta": """
    SELECT p.zip_code, x.ZCTA AS zcta FROM (SELECT DISTINCT zip_code FROM s_people) p
    LEFT JOIN s_zip_zcta x ON x.ZIP_CODE = p.zip_code""",
    "zcta_monitors": "SELECT * FROM s_pairs",
    "zcta_monitors_one": "SELECT * FROM s_pairs WHERE zcta = '90003'",
    "zcta_monitors_older": "SELECT zcta, aqs_site_id FROM s_pairs",
    "nearby_monitors": "SELECT * FROM s_nearby",
    "nearby_monitors_repeated": "SELECT * FROM s_nearby_all",
    "monitors_with_data": """
    SELECT DISTINCT aqs_site_id FROM s_nearby WHERE aqs_site_id IN (SELECT aqs_site_id FROM s_pm25)""",
    "select_no2": SELECTED + "42602 AND SampleDuration = '1 HOUR'",
    "select_ozone": SELECTED + "44201 AND SampleDuration = '8-HR RUN AVG BEGIN HOUR'",
    "select_pm25": SELECTED + "88101",
    "select_so2": SELECTED + "42401 AND SampleDuration IN ('1 HOUR', '3-HR BLK AVG')",
    "nullify_below": """
    SELECT aqs_site_id, DateLocal, ArithmeticMean, SampleDuration, ObservationCount FROM s_pm25_valid""",
    "best_reading": "SELECT aqs_site_id, date AS DateLocal, measurement FROM s_best",
    "best_by_duration": "SELECT * FROM s_so2_merged",
    "daily_by_duration": "SELECT * FROM s_pm25_merged",
    "fill_calendar": "SELECT aqs_site_id, date AS DateLocal, measurement FROM s_best_daily",
    "daily_best": "SELECT aqs_site_id, date, measurement FROM s_ozone_daily",
    "daily_pick": f"SELECT {DAILY_PM25_COLUMNS} FROM s_pm25_daily",
    "daily_pick_so2": "SELECT aqs_site_id, date, "
    + "".join(
        f"{_single(c)} AS {c}, "
        for c in ("measurement_dur01", "measurement_dur03blk", "measurement_monitor_day")
    )
    + "measurement_01hr, measurement_03hrblk FROM s_so2_daily",
    "daily_mean": f"SELECT {DAILY_PM25_COLUMNS} FROM s_pm25_daily_older",
    "zip_readings": "SELECT * FROM s_best_daily JOIN s_nearby USING (aqs_site_id)",
    "zip_daily": f"""
    SELECT zip_code, date, {_single("avg(measurement_avg)")} AS measurement_avg,
           count(measurement_avg) AS num_monitors, CAST(sum(measurement_24hr) AS BIGINT) AS num_24hr_obs,
           CAST(sum(measurement_24hr_blk_avg) AS BIGINT) AS num_24hrblk_obs,
           CAST(sum(measurement_01hr) AS BIGINT) AS num_01hr_obs
    FROM s_pm25_daily JOIN s_nearby_all USING (aqs_site_id) GROUP BY zip_code, date""",
    "trailing": f"SELECT aqs_site_id, date, {_single('measurement')} AS measurement_avg, "
    "prev_30_day_avg, prev_30_days_w_obs, prev_365_day_avg, prev_365_days_w_obs FROM ("
    + _trailing("s_best_daily", "aqs_site_id", "measurement")
    + ")",
    "label_series": """
    SELECT zip_code, ParameterName, ParameterCode, UnitsofMeasure
    FROM (SELECT DISTINCT zip_code FROM s_people) CROSS JOIN
         (SELECT ParameterName, ParameterCode, UnitsofMeasure FROM s_readings WHERE ParameterCode = 42401
          AND SampleDuration IN ('1 HOUR', '3-HR BLK AVG')
          ORDER BY ParameterName, ParameterCode, UnitsofMeasure LIMIT 1)""",
    "zip_series_no2": _zip_series(
        "s_best_daily", "s_nearby", "measurement", "count(measurement)", {},
        "SELECT * FROM s_no2 WHERE ObservationCount IS NOT NULL", "measurement_avg",
    ),
    "zip_series_ozone": _zip_series(
        "s_ozone_daily", "s_nearby", "measurement", "count(measurement)", {},
        "SELECT * FROM s_ozone WHERE ObservationCount IS NOT NULL", "measurement_avg",
    ),
    "zip_series_pm25": _zip_series(
        "s_pm25_daily", "s_nearby_all", "measurement_avg", "count(measurement_avg)", PM25_COUNTS,
        "SELECT * FROM s_pm25 WHERE SampleDuration <> '1 HOUR' OR ObservationCount = 24",
        "measurement_avg",
    ),
    "zip_series_so2": _zip_series(
        "s_so2_daily", "s_nearby", "measurement_monitor_day",
        "CAST(sum(measurement_01hr) + sum(measurement_03hrblk) AS BIGINT)", SO2_COUNTS,
        "SELECT * FROM s_so2 WHERE ObservationCount IS NOT NULL", "measurement_avg",
    ),
    "zip_series_pm25_older": _zip_series(
        "s_pm25_daily_older", "s_nearby_all", "measurement_avg", "count(*)", PM25_COUNTS, "",
        "pm25_meas_avg",
    ),
    "max_count_check": """
    SELECT aqs_site_id, DateLocal, ObservationCount, ArithmeticMean,
           max(ObservationCount) OVER (PARTITION BY aqs_site_id, DateLocal) AS maxObservationCount
    FROM s_ozone_valid""",
    "max_count_check_duration": """
    SELECT aqs_site_id, DateLocal, SampleDuration, ObservationCount, ArithmeticMean,
           max(ObservationCount) OVER (PARTITION BY aqs_site_id, DateLocal, SampleDuration)
               AS maxObservationCount
    FROM s_so2_valid""",
    "repeat_readings": """
    SELECT aqs_site_id, DateLocal, count(*) AS count FROM s_no2 GROUP BY ALL HAVING count(*) > 1""",
    "repeat_readings_duration": """
    SELECT aqs_site_id, DateLocal, SampleDuration, count(*) AS count FROM s_so2 GROUP BY ALL
    HAVING count(*) > 1""",
    "compare_methods": """
    SELECT MethodName, MethodCode, avg(ArithmeticMean) AS Measurement_Average
    FROM (SELECT *, count(*) OVER d AS n, avg(ObservationCount) OVER d AS mean,
                 max(ObservationCount) OVER d AS top
          FROM s_so2_valid WHERE aqs_site_id % 2 = 1 AND SampleDuration = '1 HOUR'
          WINDOW d AS (PARTITION BY DateLocal))
    WHERE n > 1 AND mean = top AND MethodCode IN (5, 6, 7) GROUP BY ALL""",
}


def oracle(name: str) -> str:
    """The query's text with the tables it needs in front."""
    body = ORACLES[name]
    needed, text = [], body
    for table in reversed(TABLES):
        if re.search(rf"\b{table}\b", text):
            needed.append(table)
            text += TABLES[table]
    if not needed:
        return body.strip()
    listed = ",\n".join(f"{t} AS ({TABLES[t]})" for t in reversed(needed))
    return f"WITH {listed}\n{body.strip()}"
