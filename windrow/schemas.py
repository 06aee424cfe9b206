"""Column names and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

CARRIER = "IATA_Code_Marketing_Airline"

FLIGHT_ID = T.StructField("flight_id", T.StringType(), False)

#: Raw on-time records as they come in a CSV file.
RAW = T.StructType(
    [
        T.StructField("Year", T.IntegerType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("DayofMonth", T.IntegerType()),
        T.StructField("DayOfWeek", T.IntegerType()),
        T.StructField(CARRIER, T.StringType()),
        T.StructField("Origin", T.StringType()),
        T.StructField("Dest", T.StringType()),
        T.StructField("CRSDepTime", T.LongType()),
        T.StructField("CRSArrTime", T.LongType()),
        T.StructField("DepDelay", T.DoubleType()),
        T.StructField("ArrDelay", T.DoubleType()),
        T.StructField("Cancelled", T.DoubleType()),
        T.StructField("Diverted", T.DoubleType()),
        T.StructField("Distance", T.DoubleType()),
        T.StructField("AirTime", T.DoubleType()),
    ]
)

#: Raw records plus the unique row key used for splits, samples and upserts.
FLIGHTS = T.StructType([FLIGHT_ID, *RAW.fields])

#: Silver columns, in order. ``flight_id`` leads when the input carries it.
SILVER_COLUMNS = [
    "flight_id", "Year", "Month", "DayofMonth", "DAY_OF_WEEK", "SEASON",
    "AIRLINE", "Origin", "Dest", "ROUTE", "CRSDepTime", "DEP_HOUR", "CRSArrTime",
    "DepDelay", "ArrDelay", "Cancelled", "Diverted", "Distance", "AirTime",
    "DELAY_CATEGORY", "ingested_at",
]

#: Columns of the ML feature table built from silver.
FEATURE_COLUMNS = [
    "flight_id", "Year", "Month", "DayofMonth", "DAY_OF_WEEK", "DEP_HOUR",
    "AIRLINE", "Origin", "Dest", "Distance", "AirTime", "DepDelay", "ArrDelay",
]

#: Columns of the smaller feature table built straight from raw records.
SIMPLE_FEATURE_COLUMNS = [
    "flight_id", "Month", "DayofMonth", "DayOfWeek", "DEP_HOUR", "SEASON", CARRIER,
    "Origin", "Dest", "ROUTE", "Distance", "DepDelay", "ArrDelay",
]

#: Values the rules and reports depend on (fixed values).
DELAY_THRESHOLD_MINUTES = 15
DELAY_BOUNDS = (-120, 480)
DISTANCE_BOUNDS = (50, 5000)
SPEED_BOUNDS = (100, 1000)
CRITICAL_COLUMNS = ["ArrDelay", "DepDelay", "Distance", "AirTime"]
DEFAULT_YEARS = [2018, 2019, 2020, 2021, 2022, 2023, 2024]
TEST_SIZE = 0.2
SEED = 42
RETENTION_HOURS = 168
TARGET_FILE_BYTES = 128 * 1024 * 1024
