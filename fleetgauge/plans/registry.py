"""Registered queries: every operator over the driver's tables. Each callable takes (spark, sf_dir)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.config import DEMO_WINDOWS, WindowConfig
from fleetgauge.functions.numbers import average_of, from_centi
from fleetgauge.functions.payloads import decode, state_key, truck_of_key
from fleetgauge.functions.times import iso_utc
from fleetgauge.operators import audits, fleet, quality, rates, recovery, state, validation, zscore
from fleetgauge.operators.alerts import current_alerts, sustained_alerts, sustained_alerts_by_blocks
from fleetgauge.operators.dedup import accepted_readings, dedup_readings, split_stages
from fleetgauge.operators.normalize import normalize, rejected_readings as rejected, temperature_filter, with_event_time
from fleetgauge.operators.snapshots import StateHistory
from fleetgauge.operators.state_table import StateTable
from fleetgauge.operators.windows import (
    expected_average,
    hopping_average,
    merge_partials,
    pane_sums,
    roll_up,
    tumbling_average,
    window_averages,
    window_bounds_iso,
)
from fleetgauge.plans import fleet_tables as tables
from fleetgauge.schemas import CHANGELOG_TOPIC, LOG_ROW, TELEMETRY, TELEMETRY_V1, TOPIC_PARTITIONS
from fleetgauge.session import prepare_streaming, shared_dir
from fleetgauge.sources.averages import read_averages
from fleetgauge.sources.averages import write_averages as save_averages
from fleetgauge.sources.changelog import decode_changelog, encode_changelog, read_changelog
from fleetgauge.sources.changelog import write_changelog as save_changelog
from fleetgauge.sources.fleet_csv import fleet_event_time, read_fleet_csv, write_fleet_csv
from fleetgauge.sources.logs import partition_of, spread_for_write
from fleetgauge.sources.segments import SegmentLog
from fleetgauge.sources.telemetry import decode_readings, encode_readings, unite_versions
from fleetgauge.streaming import queries as streams
from fleetgauge.streaming.resume import start_logged_state

DAILY = WindowConfig(size=86_400, step=21_600, expires=600)
SIX_HOURS = WindowConfig(size=21_600, step=3_600, expires=600)
# A size that is no whole number of hops, and that does not divide a day.
UNEVEN = WindowConfig(size=25_200, step=10_800, expires=600)

REGISTRY: dict = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _iso(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: iso_utc(c) for c in columns})


def _wire(averages: DataFrame) -> DataFrame:
    """Averages with text bounds and without the wall-clock column, which no two runs share."""
    return window_bounds_iso(averages.drop("computed_at", "seq"))


def _stored_changelog(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the changelog of the running state."""
    location = shared_dir(spark, "changelog")
    save_changelog(state.changelog_of(state.running_state(tables.normalized_readings(spark, sf_dir))), location)
    return location


def _in_batches(rows: DataFrame, purpose: str, after=None) -> SegmentLog:
    """Log rows as a log of four batches or five, cut by offset; ``after(log, batch)`` follows each."""
    spark, work = rows.sparkSession, shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(f"{work}/staging")
    staged = spark.read.schema(rows.schema).parquet(f"{work}/staging")
    log = SegmentLog(spark, f"{work}/log", LOG_ROW)
    log.append_bounded(staged, max(-(-staged.count() // 3), 1), after=after and (lambda batch: after(log, batch)))
    return log


def _telemetry_segments(spark: SparkSession, sf_dir: str) -> SegmentLog:
    return _in_batches(tables.telemetry_log(spark, sf_dir), "telemetry-log")


def _half_way(spark: SparkSession, sf_dir: str) -> dict[int, int]:
    """Half of the event numbers of each partition: one row per partition."""
    found = (
        tables.events(spark, sf_dir)
        .groupBy(F.pmod(F.col("user_id") + 1, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"))
        .agg(F.call_function("div", F.max("event_id"), F.lit(2)).alias("offset"))
    )
    return {r.partition: r.offset for r in found.collect()}


# Sources, sinks and codecs


@query
def read_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(decode_readings(tables.telemetry_log(spark, sf_dir)), "arrival")


@query
def write_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages as they lie in storage."""
    averages = tables.closed_windows(window_averages(tables.normalized_readings(spark, sf_dir), SIX_HOURS))
    location = shared_dir(spark, "averages")
    save_averages(averages, location)
    return spark.read.parquet(location).select("key", "value")


@query
def read_averages_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages written and read back."""
    averages = tables.closed_windows(window_averages(tables.normalized_readings(spark, sf_dir), DAILY))
    location = shared_dir(spark, "averages")
    save_averages(averages, location)
    return _iso(read_averages(spark, location), "window_start", "window_end", "computed_at")


@query
def write_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog as it lies in storage."""
    return spark.read.parquet(_stored_changelog(spark, sf_dir)).select("key", "value", "seq")


@query
def read_changelog_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog written and read back."""
    rows = read_changelog(spark, _stored_changelog(spark, sf_dir))
    return rows.select("key", "value.sum", "value.count", "seq")


@query
def read_log_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings behind half of the event numbers of each partition, from a log in batches whose index says which files
    hold them."""
    log = _telemetry_segments(spark, sf_dir)
    rows = decode_readings(log.read(after=_half_way(spark, sf_dir)))
    return rows.select("truck_id", "temperature", "timestamp", "seq")


@query
def read_log_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the same log that arrived in the second half of the events' time."""
    log = _telemetry_segments(spark, sf_dir)
    micros = F.unix_micros("ts")
    middle = tables.events(spark, sf_dir).agg(F.call_function("div", F.min(micros) + F.max(micros), F.lit(2))).first()[0]
    rows = decode_readings(log.read(since=datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=middle)))
    return rows.select("truck_id", "temperature", "timestamp", "seq")


@query
def fleet_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV with a header and read back."""
    location = shared_dir(spark, "fleet-csv")
    write_fleet_csv(tables.fleet_dataset(spark, sf_dir), location)
    return _iso(fleet_event_time(read_fleet_csv(spark, location)), "event_time")


@query
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New messages read by the old reader, old messages by the new one, in one table."""
    readings = tables.raw_readings(spark, sf_dir)
    new, old = encode_readings(readings), encode_readings(readings, TELEMETRY_V1)
    old_reader = new.select(F.lit("old").alias("reader"), decode("value", TELEMETRY_V1).alias("r"))
    new_reader = old.select(F.lit("new").alias("reader"), decode("value", TELEMETRY).alias("r"))
    return unite_versions(old_reader.select("reader", "r.*"), new_reader.select("reader", "r.*"))


@query
def keyed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many partitions each truck's readings are written to, and whether all numbers are in range."""
    spread = spread_for_write(tables.raw_readings(spark, sf_dir).where(F.col("truck_id").isNotNull()))
    return spread.groupBy("truck_id").agg(
        F.count_distinct("partition").alias("partitions"),
        F.bool_and(
            F.col("partition").between(0, TOPIC_PARTITIONS - 1)
            & (F.col("partition") == partition_of("truck_id"))
        ).alias("in_range"),
        F.count("*").alias("readings"),
    )


@query
def json_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as text, and a field read back from each."""
    encoded = encode_readings(tables.raw_readings(spark, sf_dir))
    return encoded.select("key", "value", decode("value", TELEMETRY)["fuel_level"].alias("fuel_level"))


@query
def state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    trucks = tables.raw_readings(spark, sf_dir).where(F.col("truck_id").isNotNull()).select("truck_id").distinct()
    return trucks.withColumn("key", state_key("truck_id")).withColumn("decoded", truck_of_key("key"))


# Filters, parsing, validation


@query
def temperature_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_filter(tables.raw_readings(spark, sf_dir)).select("seq", "truck_id", "temperature")


@query
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = with_event_time(tables.raw_readings(spark, sf_dir)).select("seq", "timestamp", "event_time")
    return _iso(timed, "event_time")


@query
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.normalized_readings(spark, sf_dir)
    return _iso(rows.select("truck_id", "temperature_c", "event_time", "timestamp", "seq"), "event_time")


@query
def rejected_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rejected(tables.raw_readings(spark, sf_dir))
    return rows.select("seq", "truck_id", "temperature", "timestamp", "reason")


@query
def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = validation.validate_messages(tables.raw_messages(spark, sf_dir))
    return judged.select("event_id", "is_valid", "reason")


@query
def validate_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = validation.validate_contract(tables.raw_readings(spark, sf_dir))
    return judged.select("seq", "in_contract")


@query
def contract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is sent on and what is set aside, counted per truck."""
    valid, aside = validation.split_by_contract(tables.raw_readings(spark, sf_dir))
    both = valid.select("truck_id", F.lit(1).alias("ok")).unionByName(aside.select("truck_id", F.lit(0).alias("ok")))
    return both.groupBy("truck_id").agg(
        F.count_if(F.col("ok") == 1).alias("sent"), F.count_if(F.col("ok") == 0).alias("set_aside")
    )


# Duplicates and stages


@query
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = dedup_readings(tables.raw_readings(spark, sf_dir))
    return firsts.select("truck_id", "timestamp", "temperature", "fuel_level", "seq")


@query
def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_stages(tables.raw_readings(spark, sf_dir)).select("seq", "truck_id", "timestamp", "stage")


# Averages


@query
def tumbling_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(tumbling_average(tables.normalized_readings(spark, sf_dir)))


@query
def hopping_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(hopping_average(tables.normalized_readings(spark, sf_dir)))


@query
def window_averages_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(window_averages(tables.normalized_readings(spark, sf_dir)))


@query
def window_averages_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(window_averages(tables.normalized_readings(spark, sf_dir), DEMO_WINDOWS))


@query
def window_averages_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(window_averages(tables.normalized_readings(spark, sf_dir), DAILY))


@query
def window_averages_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wire(window_averages(tables.normalized_readings(spark, sf_dir), UNEVEN))


@query
def window_averages_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenant in every key; the event type stands for it, so one truck has several series."""
    table = tables.events(spark, sf_dir).withColumn("tenant_id", F.col("event_type"))
    readings = tables.readings_from(table, "tenant_id")
    keys = ("tenant_id", "truck_id", "timestamp")
    rows = normalize(dedup_readings(with_event_time(readings), keys))
    return _wire(window_averages(rows, DAILY, keys=("tenant_id", "truck_id")))


@query
def rolled_up_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute sums rolled up to days, and the days merged per truck."""
    days = roll_up(pane_sums(tables.normalized_readings(spark, sf_dir), 300), 86_400)
    merged = merge_partials(days, "truck_id")
    return merged.select(
        "truck_id",
        from_centi("centi_sum").alias("sum"),
        F.col("reading_count").alias("count"),
        average_of("centi_sum", "reading_count").alias("average"),
    )


@query
def expected_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expected_average(tables.events(spark, sf_dir), "value", "event_type")


# State


@query
def truck_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.truck_totals(tables.normalized_readings(spark, sf_dir))


@query
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every customer id taken as a truck; most were never seen."""
    wanted = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("truck_id"))
    return state.state_of(wanted, truck_totals(spark, sf_dir))


@query
def running_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.running_state(tables.normalized_readings(spark, sf_dir))


def _changelog_with_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every write whose count is a multiple of seven becomes a deletion; later writes revive the key."""
    log = state.changelog_of(state.running_state(tables.normalized_readings(spark, sf_dir)))
    return log.withColumn("value", F.when(F.col("value.count") % 7 != 0, F.col("value")))


@query
def compacted_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    compacted = state.compact_changelog(_changelog_with_deletions(spark, sf_dir))
    return compacted.select("key", "value.sum", "value.count", "seq")


@query
def materialized_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.materialize_changelog(_changelog_with_deletions(spark, sf_dir))


@query
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State when half of the event numbers had arrived."""
    middle = tables.events(spark, sf_dir).select(F.call_function("div", F.max("event_id"), F.lit(2)))
    return state.state_as_of(_changelog_with_deletions(spark, sf_dir), middle.scalar())


def _changelog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with deletions as it lies in twenty partitions."""
    log = encode_changelog(_changelog_with_deletions(spark, sf_dir))
    arrivals = tables.raw_readings(spark, sf_dir).select("seq", F.col("arrival").alias("timestamp"))
    truck = truck_of_key("key")
    return log.join(arrivals, "seq").select(
        "key",
        "value",
        F.lit(CHANGELOG_TOPIC).alias("topic"),
        F.pmod(truck, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        "timestamp",
    )


def _changelog_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log read back by its decoder."""
    return decode_changelog(_changelog_rows(spark, sf_dir))


@query
def merged_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live state from a table into which the log's batches were merged one after the other."""
    table = StateTable(spark, shared_dir(spark, "state-table"), buckets=16)

    def merge(log: SegmentLog, batch: int) -> None:
        new = log.read_batch(batch)
        table.apply(decode_changelog(new), batch)
        table.merge(least=2)

    _in_batches(_changelog_rows(spark, sf_dir), "merged-changelog", merge)
    return table.live()


@query
def state_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after half of the event numbers of each partition, from the nearest snapshot and the log behind it."""
    history = None

    def snapshot(log: SegmentLog, batch: int) -> None:
        nonlocal history
        history = history or StateHistory(log, f"{log.location}-snapshots")
        history.take()

    log = _in_batches(_changelog_rows(spark, sf_dir), "snapshots", snapshot)
    return (history or StateHistory(log, f"{log.location}-snapshots")).state_at(_half_way(spark, sf_dir))


@query
def state_as_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State when half of the time had passed, from a log of several partitions."""
    micros = F.unix_micros("ts")
    middle = tables.events(spark, sf_dir).select(
        F.timestamp_micros(F.call_function("div", F.min(micros) + F.max(micros), F.lit(2)))
    )
    return state.state_as_of_time(_changelog_in_partitions(spark, sf_dir), middle.scalar())


@query
def state_as_of_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after half of the event numbers of each partition; every fifth partition has not been read."""
    until = (
        tables.events(spark, sf_dir)
        .groupBy(F.pmod(F.col("user_id") + 1, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"))
        .agg(F.call_function("div", F.max("event_id"), F.lit(2)).alias("offset"))
        .where(F.col("partition") % 5 != 0)
    )
    return state.state_as_of_offsets(_changelog_in_partitions(spark, sf_dir), until)


@query
def reconciled_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals against the state rebuilt from a log with deletions, so some trucks differ."""
    return state.reconcile_states(
        truck_totals(spark, sf_dir), materialized_changelog(spark, sf_dir), report_extra=True
    )


# Snapshot


@query
def fleet_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_latest(accepted_readings(tables.raw_readings(spark, sf_dir)))


@query
def latest_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = window_averages(tables.normalized_readings(spark, sf_dir), SIX_HOURS)
    return _iso(fleet.latest_averages(tables.closed_windows(averages)), "first_computed_at")


@query
def fleet_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = accepted_readings(tables.raw_readings(spark, sf_dir))
    return fleet.fleet_roster(accepted, tables.order_averages(spark, sf_dir, DAILY))


@query
def roster_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.roster_page(fleet_roster(spark, sf_dir))


@query
def fleet_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = fleet.fleet_positions(fleet_roster(spark, sf_dir))
    return positions.select("truck_id", "map_latitude", "map_longitude", "gps_source", "is_anomalous")


@query
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.anomalies(accepted_readings(tables.raw_readings(spark, sf_dir))).drop("arrival")


@query
def recent_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.recent_anomalies(accepted_readings(tables.raw_readings(spark, sf_dir))).drop("arrival")


@query
def recent_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fleet.recent_readings(accepted_readings(tables.raw_readings(spark, sf_dir)))
    return rows.select("seq", "truck_id", "temperature", "timestamp", "fuel_level")


@query
def telemetry_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = window_averages(tables.normalized_readings(spark, sf_dir), DAILY)
    return quality.telemetry_totals(tables.raw_readings(spark, sf_dir), averages)


@query
def stage_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = tables.closed_windows(tumbling_average(tables.normalized_readings(spark, sf_dir)))
    return _iso(rates.stage_rates(tables.raw_readings(spark, sf_dir), averages), "sampled_at")


@query
def parsed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = rates.stage_rates(tables.raw_readings(spark, sf_dir), window=3600, refresh=600)
    return _iso(rates.parsed_rate(hourly).select("sampled_at", "ingestion_rate", "filter_rate", "parsed_rate"), "sampled_at")


@query
def throughput_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(rates.throughput_history(rates.stage_rates(tables.raw_readings(spark, sf_dir))), "sampled_at")


# Observability


@query
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.consumer_lag(tables.log_offsets(spark, sf_dir))


@query
def counter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(rates.counter_rate(tables.counter_samples(spark, sf_dir)), "ts")


@query
def counter_rates_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(rates.counter_rate(tables.counter_samples_with_gaps(spark, sf_dir)), "ts")


@query
def counter_rates_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = tables.counter_samples(spark, sf_dir)
    return _iso(rates.counter_rate(samples, window=3600, span=7200), "ts")


@query
def counter_rates_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(rates.counter_rate_by_blocks(tables.counter_samples_with_gaps(spark, sf_dir)), "ts")


@query
def alert_states_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(sustained_alerts_by_blocks(tables.gauge_samples(spark, sf_dir)), "ts", "active_since")


@query
def alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(sustained_alerts(tables.gauge_samples(spark, sf_dir)), "ts", "active_since")


@query
def alerts_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = sustained_alerts(tables.gauge_samples(spark, sf_dir))
    return _iso(current_alerts(states), "ts", "active_since")


@query
def dataset_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dataset_quality(tables.fleet_dataset(spark, sf_dir))


# Audits


def _same_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch sent twice, without change."""
    return with_event_time(tables.readings_from(tables.events(spark, sf_dir), warmer=0.0))


@query
def exactly_once_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _same_twice(spark, sf_dir)
    averages = tumbling_average(normalize(dedup_readings(sent)))
    return audits.exactly_once_audit(averages, normalize(sent))


@query
def exactly_once_audit_without_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit must fail when nothing drops the copies."""
    sent = normalize(_same_twice(spark, sf_dir))
    return audits.exactly_once_audit(tumbling_average(sent), sent)


@query
def recovery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.recovery_audit(tables.normalized_readings(spark, sf_dir), shared_dir(spark, "recovery"))


@query
def throughput_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.throughput_audit(tables.raw_readings(spark, sf_dir))


@query
def average_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.normalized_readings(spark, sf_dir)
    return audits.average_audit(window_averages(rows, DAILY), rows, DAILY)


@query
def zscore_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.normalized_readings(spark, sf_dir)
    found = zscore.zscore_anomalies(rows, window=30 * 86_400, threshold=2.5)
    return found.select("truck_id", "seq", "temperature_c", "zscore")


@query
def trailing_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.normalized_readings(spark, sf_dir)
    found = zscore.trailing_zscores(rows, window=10 * 86_400, threshold=2.0)
    return found.select("truck_id", "seq", "temperature_c", "zscore")


# Streams over the same tables, run to the end of what is there


@query
def stream_window_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a stream that is run to its end, read from its sink."""
    prepare_streaming(spark)
    work = shared_dir(spark, "stream-averages")
    readings = tables.readings_from(tables.events_stream(spark, sf_dir))
    streams.finish_averages(readings, f"{work}/averages", f"{work}/checkpoint", f"{work}/clock", SIX_HOURS)
    return _wire(read_averages(spark, f"{work}/averages"))


@query
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rebuilt from the changelog a stream has written."""
    prepare_streaming(spark)
    work = shared_dir(spark, "stream-state")
    readings = tables.readings_from(tables.events_stream(spark, sf_dir), warmer=0.0)
    streams.start_state(readings, f"{work}/changelog", f"{work}/checkpoint").awaitTermination()
    return state.materialize_changelog(read_changelog(spark, f"{work}/changelog"))


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest values per truck as the snapshot stream has published them."""
    prepare_streaming(spark)
    work = shared_dir(spark, "stream-latest")

    def publish(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{work}/latest/batch={batch}")

    readings = tables.readings_from(tables.events_stream(spark, sf_dir), warmer=0.0)
    streams.start_snapshot(readings, publish, f"{work}/checkpoint").awaitTermination()
    published = spark.read.parquet(f"{work}/latest")
    values = [c for c in published.columns if c not in ("truck_id", "batch")]
    return published.groupBy("truck_id").agg(*[F.max_by(c, "batch").alias(c) for c in values])


@query
def stream_state_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a stream that has lost its checkpoint half-way and has gone on from its changelog."""
    prepare_streaming(spark)
    work = shared_dir(spark, "stream-resumed")
    changelog = SegmentLog(spark, f"{work}/changelog", LOG_ROW)

    def first_run(log: SegmentLog, batch: int) -> None:
        if batch == 1:
            start_logged_state(log, changelog, f"{work}/lost").awaitTermination()

    readings = _in_batches(tables.telemetry_log(spark, sf_dir, warmer=0.0), "stream-resumed-log", first_run)
    start_logged_state(readings, changelog, f"{work}/checkpoint").awaitTermination()
    return state.materialize_changelog(decode_changelog(changelog.read()))
