"""Declared schemas of the five CSV inputs, the stream message and the alert record."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names of the published datasets, in file order. Columns are
# strings unless they are listed in DOUBLES or INTEGERS of the dataset.
COLUMNS = {
    "arrests": """
        cb_no case_number arrest_date race
        charge_1_statute charge_1_description charge_1_type charge_1_class
        charge_2_statute charge_2_description charge_2_type charge_2_class
        charge_3_statute charge_3_description charge_3_type charge_3_class
        charge_4_statute charge_4_description charge_4_type charge_4_class
        charges_statute charges_description charges_type charges_class
    """.split(),
    "crimes": """
        id case_number date block iucr primary_type description location_description
        arrest domestic beat district ward community_area fbi_code x_coordinate
        y_coordinate year updated_on latitude longitude location
    """.split(),
    "police_stations": """
        district district_name address city state zip website phone fax tty
        x_coordinate y_coordinate latitude longitude location
    """.split(),
    "sex_offenders": """
        last first block gender race birth_date height weight victim_minor
    """.split(),
    "violence": """
        case_number date block victimization_primary incident_primary gunshot_injury_i
        unique_id zip_code ward community_area street_outreach_organization area
        district beat age sex race victimization_fbi_cd incident_fbi_cd
        victimization_fbi_descr incident_fbi_descr victimization_iucr_cd
        incident_iucr_cd victimization_iucr_secondary incident_iucr_secondary
        homicide_victim_first_name homicide_victim_mi homicide_victim_last_name
        month day_of_week hour location_description state_house_district
        state_senate_district updated latitude longitude location
    """.split(),
}
DOUBLES = {"x_coordinate", "y_coordinate", "latitude", "longitude"}
INTEGERS = {
    "crimes": {"year"},
    "sex_offenders": {"height", "weight"},
    "violence": {"month", "day_of_week", "hour"},
}
# Columns that arrive as text and are typed by the cleaning step.
TIMESTAMPS = {
    "arrests": ["arrest_date"],
    "crimes": ["date", "updated_on"],
    "violence": ["date", "updated"],
}
DATES = {"sex_offenders": ["birth_date"]}
BOOLEANS = {"crimes": ["arrest", "domestic"]}
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DATE_PATTERN = "MM/dd/yyyy"

DATASETS = tuple(COLUMNS)

# Column with the text of a CSV record that does not fit its schema.
CORRUPT = "_corrupt_record"

# The fields of a stream message, in message order.
EVENT_FIELDS = """
    id case_number date block primary_type description location_description arrest
    domestic beat district ward community_area latitude longitude ingested_at
""".split()
EVENT_REQUIRED = ["case_number", "primary_type", "district"]
EVENT_DOUBLES = ["latitude", "longitude"]
EVENT_BOOLEANS = ["arrest", "domestic"]

# The fields of an alert, in table order.
ALERT_SCHEMA = StructType(
    [
        StructField("alert_id", StringType()),
        StructField("alert_type", StringType()),
        StructField("district", StringType()),
        # Wider than the published column: a busy key may exceed an int.
        StructField("crime_count_in_window", LongType()),
        StructField("window_seconds", IntegerType()),
        StructField("threshold", IntegerType()),
        StructField("latest_crime_type", StringType()),
        StructField("latest_case_number", StringType()),
        StructField("latest_block", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("triggered_at", TimestampType()),
        StructField("severity", StringType()),
    ]
)


def raw_schema(dataset: str) -> StructType:
    """The schema a CSV file of ``dataset`` is read with."""
    return _schema(dataset, {})


def clean_schema(dataset: str) -> StructType:
    """The schema of the cleaned table of ``dataset``."""
    typed = dict.fromkeys(TIMESTAMPS.get(dataset, []), TimestampType())
    typed |= dict.fromkeys(DATES.get(dataset, []), DateType())
    typed |= dict.fromkeys(BOOLEANS.get(dataset, []), BooleanType())
    return _schema(dataset, typed)


def _schema(dataset: str, typed: dict) -> StructType:
    def kind(name):
        if name in typed:
            return typed[name]
        if name in DOUBLES:
            return DoubleType()
        if name in INTEGERS.get(dataset, ()):
            return IntegerType()
        return StringType()

    return StructType([StructField(name, kind(name)) for name in COLUMNS[dataset]])
