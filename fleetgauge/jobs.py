"""Jobs for spark-submit or ``python -m fleetgauge.jobs``.

    averages LOG TARGET CHECKPOINT     stream readings to window averages
    state LOG TARGET CHECKPOINT        stream readings to the state changelog
    validate-dataset CSV               quality report; exit code 0 PASS, 1 FAIL
    exactly-once LOG AVERAGES          audit; exit code 0 PASSED, 1 FAILED, 2 INCONCLUSIVE
    recovery LOG                       audit; exit code 0 PASSED, 1 FAILED
    totals LOG                         counters of the raw readings

LOG is a folder of log rows, a log in batches with ``--format segments``, or a broker list with ``--format kafka``. Window durations come from the
environment (``WindowConfig.from_env``). Reports are single rows, printed as JSON.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.config import WindowConfig
from fleetgauge.operators.audits import exactly_once_audit
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.quality import dataset_quality, telemetry_totals
from fleetgauge.operators.recovery import recovery_audit
from fleetgauge.session import build_session, shared_dir
from fleetgauge.sources.averages import read_averages
from fleetgauge.sources.fleet_csv import read_fleet_csv
from fleetgauge.sources.logs import SEGMENTS
from fleetgauge.sources.telemetry import read_telemetry
from fleetgauge.streaming.clock import clock_stream, open_clock
from fleetgauge.streaming.queries import finish_averages, start_averages, start_state

EXIT_CODES = {"PASS": 0, "PASSED": 0, "FAIL": 1, "FAILED": 1, "INCONCLUSIVE": 2}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fleetgauge", description="fleet telemetry jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        sub.add_argument("--format", default="parquet", help="kafka, segments, parquet or json")
        return sub

    for name in ("averages", "state"):
        sub = job(name, "log", "target", "checkpoint")
        sub.add_argument("--start", default="latest", help="where a new query starts in the log: earliest, latest, offsets as JSON; of segments also a time")
        sub.add_argument("--every", help="trigger interval; without it, process what is there and stop")
        if name == "averages":
            sub.add_argument("--finish", action="store_true", help="close the last windows too: no more readings will come")
    job("validate-dataset", "csv")
    job("exactly-once", "log", "averages").add_argument(
        "--cutoff", type=datetime.fromisoformat, help="count only readings, and windows that start, before this time"
    )
    job("recovery", "log")
    job("totals", "log")
    return parser


def _report(report: DataFrame) -> int:
    row = report.first().asDict()
    print(json.dumps(row, default=str))
    return EXIT_CODES[row["verdict"]] if "verdict" in row else 0


def run(spark: SparkSession, arguments: list[str], environ=os.environ) -> int:
    args = _parser().parse_args(arguments)
    if args.job == "validate-dataset":
        return _report(dataset_quality(read_fleet_csv(spark, args.csv)))
    if args.job in ("averages", "state"):
        keep = {"keep_start": f"{args.checkpoint}-start"} if args.format == SEGMENTS else {}
        readings = read_telemetry(spark, args.log, args.format, streaming=True, start=args.start, **keep)
        if args.job == "averages":
            config = WindowConfig.from_env(environ)
            clock = f"{args.checkpoint}-clock"
            if args.finish:
                finish_averages(readings, args.target, args.checkpoint, clock, config)
                return 0
            # The markers are read from the first run on: a checkpoint knows the sources that its query began with.
            open_clock(spark, clock)
            markers = clock_stream(spark, clock)
            query = start_averages(readings, args.target, args.checkpoint, config, every=args.every, clock=markers)
        else:
            query = start_state(readings, args.target, args.checkpoint, every=args.every)
        query.awaitTermination()
        return 0
    readings = read_telemetry(spark, args.log, args.format)
    if args.job == "totals":
        return _report(telemetry_totals(readings))
    timed = with_event_time(readings)
    if args.job == "recovery":
        return _report(recovery_audit(normalize(dedup_readings(timed)), shared_dir(spark, "recovery")))
    sent = normalize(timed)
    if args.cutoff is not None:
        sent = sent.where(F.col("event_time") < F.lit(args.cutoff))
    return _report(exactly_once_audit(read_averages(spark, args.averages), sent, args.cutoff))


if __name__ == "__main__":
    raise SystemExit(run(build_session(), sys.argv[1:]))
