"""Fleet telemetry derived from the ``events`` table, and tables derived from that.

Every derivation reads the whole table and is a row-wise projection (or an aggregate the library offers), so
its size follows the input. The projection gives each operator something to do: temperatures at or below zero,
missing fields, text that is no timestamp, and a second delivery of every reading with a different
temperature, so that "the first one wins" is visible in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.config import WindowConfig
from fleetgauge.functions.numbers import to_centi
from fleetgauge.functions.payloads import encode
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.windows import TUMBLING, window_averages
from fleetgauge.schemas import TELEMETRY, TELEMETRY_TOPIC, TOPIC_PARTITIONS
from fleetgauge.session import pin_utc

# The second delivery arrives after every first one.
REPLAY_SEQ = 1 << 40
REPLAY_DELAY = "INTERVAL 2 SECONDS"


EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with ``ts`` as an instant, which watermarks and windows need."""
    pin_utc(spark)
    table = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == n - 1


def readings_from(table: DataFrame, *carried: str, warmer: float = 1.0) -> DataFrame:
    """Telemetry readings of an events table, each delivered twice, the second time ``warmer`` degrees up.
    ``carried`` columns come along."""
    copy = F.col("_copy")
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    suffix = (
        F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+00:00").otherwise("")
    )
    once = table.select(
        F.when(~_every(101), F.col("user_id") + 1).alias("truck_id"),
        F.when(~_every(89), F.col("value") - 5).alias("_temperature"),
        F.when(_every(97), "not-a-timestamp").otherwise(F.concat(clock, suffix)).alias("timestamp"),
        F.when(~_every(3), F.get_json_object("props", "$.k").cast("double")).alias("fuel_level"),
        F.when(~_every(4), 25 + (F.col("event_id") % 2400) / 100).alias("latitude"),
        F.when(~_every(4), -125 + (F.col("event_id") % 5800) / 100).alias("longitude"),
        "event_id",
        "ts",
        *carried,
        F.explode(F.array(F.lit(0), F.lit(1))).alias("_copy"),
    )
    return once.select(
        "truck_id",
        F.round(F.col("_temperature") + copy * warmer, 2).alias("temperature"),
        "timestamp",
        "fuel_level",
        "latitude",
        "longitude",
        (F.col("event_id") + copy * REPLAY_SEQ).alias("seq"),
        F.when(copy == 0, F.col("ts")).otherwise(F.col("ts") + F.expr(REPLAY_DELAY)).alias("arrival"),
        *carried,
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from(events(spark, sf_dir))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of its files."""
    pin_utc(spark)
    stream = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def telemetry_log(spark: SparkSession, sf_dir: str, warmer: float = 1.0) -> DataFrame:
    """The readings as log rows of JSON messages in twenty partitions."""
    readings = readings_from(events(spark, sf_dir), warmer=warmer)
    partition = F.coalesce(F.pmod("truck_id", F.lit(TOPIC_PARTITIONS)), F.lit(0)).cast("int")
    return readings.select(
        F.col("truck_id").cast("string").alias("key"),
        encode(*TELEMETRY.names).alias("value"),
        F.lit(TELEMETRY_TOPIC).alias("topic"),
        partition.alias("partition"),
        F.col("seq").alias("offset"),
        F.col("arrival").alias("timestamp"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages ``(event_id, value)``, most of them well formed and some wrong in each possible way."""

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), value)

    number = F.round(F.col("value") - 5, 2).cast("string")
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    text = F.concat(F.lit('"'), clock, F.lit('"'))
    truck = (
        F.when(_every(11), '"one"').when(_every(13), "1.0").otherwise((F.col("user_id") + 1).cast("string"))
    )
    temperature = F.when(_every(17), '"hot"').when(_every(19), "null").otherwise(number)
    time = F.when(_every(23), '"18/07/2026"').when(_every(29), "1784364645").otherwise(text)
    fields = F.array_compact(
        F.array(
            F.when(~_every(31), field("truck_id", truck)),
            F.when(~_every(37), field("temperature", temperature)),
            F.when(~_every(41), field("timestamp", time)),
        )
    )
    message = F.concat(F.lit("{"), F.array_join(fields, ", "), F.lit("}"))
    return events(spark, sf_dir).select(
        "event_id", F.when(_every(43), F.substring(message, 2, 20)).otherwise(message).alias("value")
    )


def closed_windows(averages: DataFrame) -> DataFrame:
    """Averages as the sink log holds them: computed when the window closed, in the order of closing."""
    tumbling_last = F.when(F.col("window_type") == TUMBLING, 1).otherwise(0)
    return averages.withColumns({
        "computed_at": F.col("window_end"),
        "seq": F.unix_micros("window_end") * 2 + tumbling_last,
    })


def order_averages(spark: SparkSession, sf_dir: str, config: WindowConfig) -> DataFrame:
    """Averages of a second fleet, one truck per customer with orders as readings. Most of its trucks have no
    telemetry, so a roster of both has trucks known from averages alone."""
    pin_utc(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    normalized = orders.select(
        F.col("o_custkey").alias("truck_id"),
        to_centi(F.col("o_totalprice") / 1000).alias("temperature_centi"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
    )
    return closed_windows(window_averages(normalized, config))


def fleet_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline data set: text ids, wider temperatures, day-first timestamps."""
    return events(spark, sf_dir).select(
        F.when(~_every(101), F.concat(F.lit("UNIT-"), F.col("user_id").cast("string"))).alias("truck_id"),
        F.when(~_every(89), F.round(F.col("value") - 25, 2)).alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("fuel"),
        (25 + (F.col("event_id") % 2400) / 100).alias("latitude"),
        (-125 + (F.col("event_id") % 5800) / 100).alias("longitude"),
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("timestamp"),
    )


def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of a consumer group: some ahead, some behind, some never committed."""
    high = F.max("event_id") + 1
    partition = F.col("partition")
    return (
        events(spark, sf_dir)
        .withColumn("partition", (F.col("user_id") % TOPIC_PARTITIONS).cast("int"))
        .groupBy(F.col("event_type").alias("topic"), "partition")
        .agg(
            high.alias("high"),
            F.when(partition == 3, -1001)
            .when(partition == 5, high + 2)
            .otherwise(F.max(F.when(F.col("value") > 40, F.col("event_id"))))
            .alias("committed"),
        )
    )


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per event type that restarts now and then, one sample per event."""
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("metric"), "ts")
        .agg(F.max(F.col("event_id") % 1000).cast("double").alias("value"))
    )


def counter_samples_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counters, with NaN or nothing for some of the samples."""
    value = F.col("value")
    return counter_samples(spark, sf_dir).withColumn(
        "value", F.when(value % 7 == 6, F.lit(float("nan"))).when(value % 11 != 10, value)
    )


def gauge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three gauges the alert rules watch, sampled at each event."""
    value = F.col("value")
    gauges = F.array(
        F.struct(
            F.lit("kafka_connected").alias("metric"), F.when(value < 40, 0.0).otherwise(1.0).alias("value")
        ),
        F.struct(F.lit("workers_running").alias("metric"), F.floor(value / 30).cast("double").alias("value")),
        F.struct(F.lit("anomalies").alias("metric"), value.alias("value")),
    )
    return (
        events(spark, sf_dir)
        .select("ts", F.explode(gauges).alias("gauge"))
        .groupBy("gauge.metric", "ts")
        .agg(F.max("gauge.value").alias("value"))
    )


def normalized_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated and normalised readings: the input of windows and running state."""
    return normalize(dedup_readings(with_event_time(raw_readings(spark, sf_dir))))
