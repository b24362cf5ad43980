"""The offline fleet data set, a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.schemas import FLEET_CSV, FLEET_CSV_TIME


def read_fleet_csv(spark: SparkSession, location: str) -> DataFrame:
    """Rows with the columns the header names, typed by the data-set schema; unknown columns are text.

    The header is read first, since a data set may lack columns or have them in another order. A folder whose files
    differ in that is refused when it is read, not read by position.
    """
    header = spark.read.option("header", True).csv(location).columns
    types = {f.name: f.dataType.simpleString() for f in FLEET_CSV.fields}
    schema = ", ".join(f"`{name}` {types.get(name, 'string')}" for name in header)
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(location)


def fleet_event_time(dataset: DataFrame) -> DataFrame:
    """Add ``event_time``; the data set writes day first and no seconds."""
    return dataset.withColumn("event_time", F.try_to_timestamp("timestamp", F.lit(FLEET_CSV_TIME)))


def write_fleet_csv(dataset: DataFrame, location: str) -> None:
    dataset.write.mode("overwrite").option("header", True).csv(location)
