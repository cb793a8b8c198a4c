"""Study tables made of the bundled test tables.

Each function gives one input table of the operators under that table's own
column names. `sql.py` holds the same tables as DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortair.operators.joins import attach
from cohortair.settings import AREA_MEASURES, NO2, OZONE, PM25, SO2, CodeSetNames
from cohortair.sources.tables import read_table

# Part types stand for code sets.
NAMES = CodeSetNames(
    pcr_antigen="STANDARD", antibody="PROMO", diagnosis="ECONOMY", positive_result="LARGE"
)
# Order priorities stand for the sets of already tagged events.
PRIORITY_NAMES = CodeSetNames(
    pcr_antigen="1-URGENT", antibody="2-HIGH", diagnosis="3-MEDIUM", positive_result="5-LOW"
)

# Race texts by nation; 25 nations, so every rule is met.
RACES = (
    "Black", "African American", "White", "Asian or Pacific Islander", "Asian Indian",
    "Asian", "Filipino", "Korean", "Sri Lankan", "Hmong",
    "Other Pacific Islander", "Polynesian", "Native Hawaiian", "Micronesian", "Melanesian",
    "Other Race", "Multiple races", "More than one", "Barbadian", "white",
    "Hispanic", "Black or African", "Vietnamese", "Thai", "Unknown",
)

# Part types and sample durations (by return flag) of each pollutant's readings.
READINGS = {
    NO2: (("STANDARD",), ("1 HOUR", "1 HOUR", "3-HR BLK AVG")),
    OZONE: (("PROMO",), ("8-HR RUN AVG BEGIN HOUR", "8-HR RUN AVG BEGIN HOUR", "1 HOUR")),
    PM25: (("ECONOMY",), ("24 HOUR", "24-HR BLK AVG", "1 HOUR")),
    SO2: (("LARGE", "MEDIUM", "SMALL"), ("1 HOUR", "3-HR BLK AVG", "24 HOUR")),
}


class Study:
    """The study tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, name, self.folder)
        return self._read[name]

    def members(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("concept_id"),
            F.col("p_type").alias("concept_set_name"),
            F.when(F.col("p_size") > 5, "true").otherwise("false").alias("is_most_recent_version"),
            F.when(F.col("p_brand") != "Brand#7", F.col("p_size")).alias("version"),
        )

    def rules(self) -> DataFrame:
        name = F.col("concept_set_name")
        return self.table("part").select(F.col("p_type").alias("concept_set_name")).distinct().select(
            "concept_set_name",
            F.lower(name).alias("column_name"),
            F.when(name == "SMALL", "visit_occurrence")
            .otherwise("condition_occurrence, observation")
            .alias("domain"),
            (~name.isin("SMALL", "MEDIUM")).cast("int").alias("comorbidity"),
            (name == "SMALL").cast("int").alias("er_only_visit"),
        )

    def _order_lines(self) -> DataFrame:
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def measurement(self) -> DataFrame:
        return self._order_lines().select(
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderdate").cast("date").alias("measurement_date"),
            F.col("l_partkey").alias("measurement_concept_id"),
            F.col("l_suppkey").alias("value_as_concept_id"),
        )

    def conditions(self) -> DataFrame:
        return self._order_lines().select(
            F.col("o_custkey").alias("person_id"),
            F.when(F.col("l_tax") > 0, F.col("l_shipdate").cast("date")).alias(
                "condition_start_date"
            ),
            F.col("l_partkey").alias("condition_concept_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("condition_occurrence_id"),
        )

    def labs(self) -> DataFrame:
        return (
            self.table("orders")
            .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select(
                F.col("o_custkey").alias("person_id"),
                F.col("o_orderdate").cast("date").alias("measurement_date"),
                F.col("o_orderpriority").alias("concept_set_name"),
            )
        )

    def diagnoses(self) -> DataFrame:
        return (
            self.table("orders")
            .where(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"))
            .select(
                F.col("o_custkey").alias("person_id"),
                F.col("o_orderdate").cast("date").alias("condition_start_date"),
                F.col("o_orderpriority").alias("concept_set_name"),
            )
        )

    def person(self) -> DataFrame:
        key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
        part = F.floor(F.col("c_acctbal")).cast("int")
        race = F.element_at(F.array(*[F.lit(r) for r in RACES]), nation + 1)
        return self.table("customer").select(
            key.alias("person_id"),
            F.when(nation != 7, F.pmod(part, F.lit(101)) + 1900).alias("year_of_birth"),
            F.when(nation != 8, F.pmod(part, F.lit(12)) + 1).alias("month_of_birth"),
            F.when(nation != 9, F.pmod(part, F.lit(31)) + 1).alias("day_of_birth"),
            F.when(segment == "BUILDING", "Hispanic or Latino")
            .when(segment != "FURNITURE", "Not Hispanic or Latino")
            .alias("ethnicity_concept_name"),
            F.when(nation != 24, race).alias("race_concept_name"),
            F.when(segment == "MACHINERY", "Male")
            .when(segment == "AUTOMOBILE", "FEMALE")
            .when(segment == "HOUSEHOLD", "female")
            .when(segment == "FURNITURE", "Ambiguous")
            .alias("gender_concept_name"),
            F.when(F.col("c_acctbal") >= 0, nation).alias("location_id"),
            F.pmod(nation, F.lit(6)).alias("data_partner_id"),
        )

    def location(self) -> DataFrame:
        five = (F.col("n_nationkey") + 10001).cast("string")
        region = F.col("n_regionkey")
        return self.table("nation").select(
            F.col("n_nationkey").alias("location_id"),
            F.concat(F.lit("City of "), F.col("n_name")).alias("city"),
            F.concat(F.lit("S"), region.cast("string")).alias("state"),
            F.when(region == 0, F.concat(F.lit("  "), five, F.lit(" ")))
            .when(region == 1, F.concat(five, F.lit("-1234")))
            .when(F.col("n_nationkey") == 2, F.lit("1000"))
            .when(F.col("n_nationkey") == 3, F.lit("1000x9"))
            .otherwise(five)
            .alias("zip"),
            F.col("n_name").alias("county"),
        )

    def manifest(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("data_partner_id"),
            F.to_date(F.lit("2022-06-01")).alias("run_date"),
            F.col("r_name").alias("cdm_name"),
            F.lit("5.3").alias("cdm_version"),
            F.when(F.col("r_regionkey") < 3, "N").otherwise("Y").alias("shift_date_yn"),
            (F.col("r_regionkey") * 7).alias("max_num_shift_days"),
        )

    def visits(self) -> DataFrame:
        """Lines are visits; the 'F' lines of an order form one stay."""
        line = self.table("lineitem")
        shipped = F.col("l_shipdate").cast("date")
        stays = (
            line.where("l_linestatus = 'F'")
            .groupBy(F.col("l_orderkey").alias("macrovisit_id"))
            .agg(F.min(shipped).alias("macrovisit_start_date"), F.max(shipped).alias("macrovisit_end_date"))
        )
        # Lines of no stay have a null id, half of all lines: `attach` spreads them.
        lines = (
            self._order_lines()
            .select(
                F.col("o_custkey").alias("person_id"),
                F.substring("o_orderpriority", 1, 1).cast("int").alias("data_partner_id"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_occurrence_id"),
                F.col("l_partkey").alias("visit_concept_id"),
                F.col("l_returnflag").alias("visit_concept_name"),
                shipped.alias("visit_start_date"),
                F.date_add(shipped, F.col("l_linenumber")).alias("visit_end_date"),
                F.when(F.col("l_linestatus") == "F", F.col("l_orderkey")).alias("macrovisit_id"),
            )
        )
        return attach(lines, stays, "macrovisit_id")

    def death(self) -> DataFrame:
        return self.table("orders").where("o_orderstatus = 'F'").select(
            F.col("o_custkey").alias("person_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias(
                "death_date"
            ),
            F.col("o_orderpriority").alias("cause"),
            F.lit(1).alias("data_partner_id"),
        )

    def scores(self) -> DataFrame:
        balance = F.col("c_acctbal")
        # Scores of people with debts belong to people who are in no other table.
        person = F.when(balance > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
        return self.table("customer").select(
            person.alias("person_id"),
            F.col("c_mktsegment").alias("Severity_Type"),
            F.col("c_nationkey").alias("data_partner_id"),
            F.to_date(F.lit("2020-05-01")).alias("visit_start_date"),
            (F.col("c_custkey") * 2).alias("visit_occurrence_id"),
            (balance > 5000).cast("int").alias("AKI_in_hospital"),
            (balance > 8000).cast("int").alias("ECMO"),
            (balance > 7000).cast("int").alias("Invasive_Ventilation"),
            F.floor(balance).alias("Q_Score"),
            F.floor(balance / 100).alias("BMI"),
            F.lit(170).alias("Height"),
            F.floor(balance / 90).alias("Weight"),
            F.substring("c_mktsegment", 1, 1).alias("blood_type"),
            F.when(balance > 4000, "Smoker").alias("smoking_status"),
        )

    def summary(self) -> DataFrame:
        return (
            self.table("orders")
            .where("o_orderpriority = '4-NOT SPECIFIED'")
            .groupBy(F.col("o_custkey").alias("person_id"))
            .agg(F.count(F.lit(1)).alias("MDs"))
        )

    def area_attributes(self) -> DataFrame:
        """Customers per region as text, one column per measure, one not a number."""
        share = {
            name: F.sum((F.pmod(F.length("c_name") + F.col("c_nationkey"), F.lit(13)) == i).cast("int"))
            for i, name in enumerate(AREA_MEASURES)
        }
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy((F.col("n_regionkey") + 90001).cast("string").alias("ZCTA"))
            .agg(
                *[
                    (F.when(n > 0, n.cast("string")).otherwise("n/a")).alias(name)
                    for name, n in share.items()
                ]
            )
        )

    def crosswalk_base(self) -> DataFrame:
        # One nation's ZIP is nobody's, and so its people's ZIP has no ZCTA.
        return self.table("nation").select(
            F.when(F.col("n_name") == "NATION_4", "99999")
            .otherwise((F.col("n_nationkey") + 10001).cast("string"))
            .alias("ZIP_CODE"),
            F.col("n_name").alias("PO_NAME"),
            (F.col("n_regionkey") + 90001).cast("string").alias("ZCTA"),
        )

    def crosswalk_update(self) -> DataFrame:
        """A second ZCTA for one region's ZIPs, and repeats for another's."""
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .where(F.col("r_name").isin("AMERICA", "EUROPE"))
            .select(
                (F.col("n_nationkey") + 10001).cast("string").alias("ZIP_CODE"),
                F.col("n_name").alias("PO_NAME"),
                F.when(F.col("r_name") == "EUROPE", "90001")
                .otherwise((F.col("n_regionkey") + 90001).cast("string"))
                .alias("ZCTA"),
            )
        )

    def monitor_pairs(self) -> DataFrame:
        return self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            (F.col("n_regionkey") + 90001).cast("string").alias("ZCTA"),
            F.col("s_suppkey").alias("Monitor_ID"),
            F.floor(F.abs("s_acctbal")).alias("Distance_m"),
            (F.col("s_acctbal") > 0).cast("int").alias("WithinZCTA"),
        )

    def people_zips(self) -> DataFrame:
        """Customers with a cleaned ZIP and their first urgent order's date."""
        first = (
            self.table("orders")
            .where("o_orderpriority = '1-URGENT'")
            .groupBy(F.col("o_custkey").alias("person_id"))
            .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_pos_pcr_antigen_date"))
        )
        return (
            self.table("customer")
            .select(
                F.col("c_custkey").alias("person_id"),
                F.when(F.col("c_acctbal") >= 0, (F.col("c_nationkey") + 10001).cast("string")).alias(
                    "zip_code"
                ),
                F.when(F.col("c_mktsegment") == "BUILDING", "Y").otherwise("N").alias("shift_date_yn"),
            )
            .join(first, "person_id")
        )

    def climate(self, shipped: bool) -> DataFrame:
        """Daily order totals per nation; of shipped orders or of the others.

        One nation's totals stand under a ZIP that is nobody's.
        """
        wanted = F.col("o_orderstatus") == "F"
        return (
            self.table("orders")
            .where(wanted if shipped else ~wanted)
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(
                F.when(F.col("c_nationkey") == 11, "99999")
                .otherwise((F.col("c_nationkey") + 10001).cast("string"))
                .alias("POSTCODE"),
                F.col("o_orderdate").cast("date").alias("Date"),
            )
            .agg(
                F.count(F.lit(1)).cast("double").alias("MeanTemp"),
                F.max("o_custkey").cast("double").alias("Precip"),
                F.min(F.when(F.col("o_orderpriority") < "4", F.col("o_custkey")))
                .cast("double")
                .alias("DewPoint"),
            )
        )

    def readings(self) -> DataFrame:
        """Lines as readings of the pollutant their part type stands for.

        Return flags stand for the pollutant's sample durations and one of
        another, line numbers for observation counts (24 for the highest) and
        for methods, discounts in cents less two for values; each pollutant is
        spelt in two ways.
        """
        type_, flag, line = F.col("p_type"), F.col("l_returnflag"), F.col("l_linenumber")
        code, name, duration = (F.when(F.lit(False), None) for _ in range(3))
        for kind, (types, labels) in READINGS.items():
            of_kind = type_.isin(*types)
            label = F.when(flag == "A", labels[0]).when(flag == "N", labels[1]).otherwise(labels[2])
            code = code.when(of_kind, kind.code)
            name = name.when(of_kind, F.concat(F.lit(kind.name), F.when(line > 3, " (local)").otherwise("")))
            duration = duration.when(of_kind, label)
        return (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_suppkey").alias("aqs_site_id"),
                F.col("l_shipdate").cast("date").alias("DateLocal"),
                (F.round(F.col("l_discount") * 100) - 2 + 0.0).alias("ArithmeticMean"),
                F.when(line > 5, "ppb").otherwise("Parts per billion").alias("UnitsofMeasure"),
                duration.alias("SampleDuration"),
                F.when(F.col("l_tax") > 0, F.when(line > 4, 24).otherwise(line)).alias(
                    "ObservationCount"
                ),
                code.alias("ParameterCode"),
                name.alias("ParameterName"),
                F.col("p_brand").alias("CityName"),
                F.lit("State").alias("StateName"),
                F.lit(0.0).alias("Latitude"),
                F.lit(0.0).alias("Longitude"),
                line.alias("MethodCode"),
                F.concat(F.lit("method "), line.cast("string")).alias("MethodName"),
            )
        )
