"""Readers for the file families the analyses start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions.temporal import parse_date
from terrella.operators.columns import cast_columns
from terrella.sources import readers

# Column names and types of the supported input files.
TRIP_FILE = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
    "passenger_count INT, trip_distance FLOAT, pickup_longitude FLOAT, pickup_latitude FLOAT, "
    "RatecodeID INT, store_and_fwd_flag INT, dropoff_longitude FLOAT, dropoff_latitude FLOAT, "
    "payment_type INT, fare_amount FLOAT, extra FLOAT, mta_tax FLOAT, tip_amount FLOAT, "
    "total_amount FLOAT, tolls_amount FLOAT, improvement_surcharge FLOAT"
)
OBSERVATION_FILE = (
    "station_id STRING, date STRING, type STRING, val DOUBLE, "
    "mflag STRING, qflag STRING, sflag STRING, obs_time STRING"
)
STATION_FILE = {"station_id": (0, 11), "latitude": (12, 20), "longitude": (21, 30)}
COLLISION_COLUMNS = (
    "process lepton_pT lepton_eta lepton_phi missing_energy_magnitude missing_energy_phi "
    "jet_1_pt jet_1_eta jet_1_phi jet_1_b_tag jet_2_pt jet_2_eta jet_2_phi jet_2_b_tag "
    "jet_3_pt jet_3_eta jet_3_phi jet_3_b_tag jet_4_pt jet_4_eta jet_4_phi jet_4_b_tag "
    "m_jj m_jjj m_lv m_jlv m_bb m_wbb m_wwbb"
).split()


def trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Monthly trip files with a header."""
    return readers.read_csv_typed(spark, path, TRIP_FILE)


def observations(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Yearly gzip files of daily observations, with the day as ``obs_ts``."""
    kept = ["station_id", "date", "type", "val"]
    rows = readers.read_csv_headerless(spark, path, OBSERVATION_FILE, kept, partitions)
    return rows.select("station_id", parse_date(F.col("date")).alias("obs_ts"), "type", "val")


def stations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fixed-width station list with numeric coordinates."""
    cut = readers.read_fixed_width(spark, path, STATION_FILE)
    return cast_columns(cut, {"latitude": "double", "longitude": "double"})


def collisions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Collision files without a header: the label, then the measured and derived features."""
    kinds = ["FLOAT"] * len(COLLISION_COLUMNS)
    rows = readers.read_csv_positional(spark, path, kinds, COLLISION_COLUMNS)
    return rows.withColumn("process", F.col("process").cast("int"))
