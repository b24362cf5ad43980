"""The changelog of per-truck state: upserts in order, a null value deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetgauge.functions.payloads import decode, state_key
from fleetgauge.schemas import CHANGELOG_TOPIC, STATE_VALUE
from fleetgauge.sources.logs import KAFKA, arrival_number, read_log, write_log

_FILE_SCHEMA = "key string, value string, seq bigint, batch bigint"


def encode_changelog(changelog: DataFrame) -> DataFrame:
    """Wire form: the value as JSON text, null for a deletion."""
    return changelog.withColumn("value", F.to_json("value"))


def decode_changelog(rows: DataFrame) -> DataFrame:
    """``(key, value struct, seq)``; log rows take their order from partition and offset, and keep both and the time
    of arrival."""
    order = F.col("seq") if "seq" in rows.columns else arrival_number()
    value = F.when(F.col("value").isNotNull(), decode("value", STATE_VALUE))
    place = [c for c in ("partition", "offset", "timestamp") if c in rows.columns]
    return rows.select("key", value.alias("value"), order.alias("seq"), *place)


def read_changelog(
    spark: SparkSession, location: str, fmt: str = "parquet", topic: str = CHANGELOG_TOPIC, **options: str
) -> DataFrame:
    """The whole log from its start, with ``seq`` in the order of each key."""
    if fmt == KAFKA:
        return decode_changelog(read_log(spark, location, fmt, topic, **options))
    return decode_changelog(spark.read.format(fmt).schema(_FILE_SCHEMA).options(**options).load(location))


def write_changelog(
    changelog: DataFrame, location: str, fmt: str = "parquet", topic: str = CHANGELOG_TOPIC
) -> None:
    """Append upserts of a table."""
    encoded = encode_changelog(changelog)
    write_log(encoded.select("key", "value") if fmt == KAFKA else encoded, location, fmt, topic)


def stream_changelog(
    totals: DataFrame,
    location: str,
    checkpoint: str,
    fmt: str = "parquet",
    topic: str = CHANGELOG_TOPIC,
) -> DataStreamWriter:
    """Writer of the changed totals ``(truck_id, sum, count)`` of each micro-batch.

    In files each batch owns one folder and replaces it, so a batch that is run again after a failure leaves
    one copy; its number is the order. A log gets the batch at least once, which replay tolerates.
    """

    def write_batch(changed: DataFrame, batch: int) -> None:
        upserts = changed.select(
            state_key("truck_id").alias("key"), F.to_json(F.struct("sum", "count")).alias("value")
        )
        if fmt == KAFKA:
            write_log(upserts, location, fmt, topic)
        else:
            upserts.withColumn("seq", F.lit(batch).cast("bigint")).write.mode("overwrite").format(fmt).save(
                f"{location}/batch={batch}"
            )

    return (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
