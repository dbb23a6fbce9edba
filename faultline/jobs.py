"""Jobs for `spark-submit`: land and clean, publish rollups and reports, replay, and raise alerts.

    spark-submit --py-files faultline.zip faultline/jobs.py clean --source /landing/villes --city \
        --target /tables/villes
    spark-submit ... faultline/jobs.py precursors --source /tables/villes --entity ville --target /out

Paths may be on any file system the cluster reaches. Options of connectors are given as
`--option name=value`, once per option.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from faultline.operators.clean import clean_readings, rejects
from faultline.operators.risk import alerts_of_sums
from faultline.operators.rollups import hourly_stats
from faultline.plans.daily import TABLES, publish_days
from faultline.plans.reports import aggregation_report, precursor_report
from faultline.schemas import (
    CLEAN_CITY_READINGS,
    CLEAN_READINGS,
    RAW_CITY_READINGS,
    RAW_READINGS,
)
from faultline.session import build_session, scratch
from faultline.sources.readers import read_csv, read_parquet, read_stream
from faultline.sources.sinks import save_tables, write_csv, write_days, write_parquet
from faultline.streaming import alerts, messages, repair


def options(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def cleaned(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source_format == "parquet":
        return read_parquet(spark, args.source)
    return read_csv(spark, args.source, CLEAN_CITY_READINGS if args.city else CLEAN_READINGS)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw CSV files to cleaned readings, and the raw rows with unreadable fields beside them."""
    raw = read_csv(spark, args.source, RAW_CITY_READINGS if args.city else RAW_READINGS)
    write = write_csv if args.format == "csv" else write_parquet
    write(clean_readings(raw), args.target)
    if args.rejects:
        write_parquet(rejects(raw), args.rejects)


def hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    write_parquet(hourly_stats(cleaned(spark, args)), args.target)


def aggregate(spark: SparkSession, args: argparse.Namespace) -> None:
    report = aggregation_report(cleaned(spark, args), args.entity)
    save_tables(report, args.target)


def precursors(spark: SparkSession, args: argparse.Namespace) -> None:
    report = precursor_report(
        cleaned(spark, args), args.frame_seconds, args.entity, args.key, target=args.target
    )
    # The features are there already.
    save_tables({name: df for name, df in report.items() if name != "precurseurs"}, args.target)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """A table by day, from readings that `land` has stored by day; all days, or some again."""
    days = [date.fromisoformat(day) if day else None for day in (args.first, args.last)]
    publish_days(
        spark, args.source, args.target, args.table, *days, args.frame_seconds, args.entity
    )


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cleaned readings to folders by day; days that arrive again are replaced."""
    write_days(cleaned(spark, args), args.target, "date")


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cleaned readings to messages: at once, or with `--files-per-trigger` as a stream."""
    to = options(args.option)
    if args.files_per_trigger:
        schema = read_parquet(spark, args.source).schema
        messages.replay_paced(
            spark, args.source, schema, args.checkpoint, args.format, to, args.laps,
            args.lap_seconds, args.files_per_trigger, args.every,
        )
        return
    sent = messages.encode_messages(cleaned(spark, args), args.laps, args.lap_seconds)
    messages.write_messages(sent, args.format, to)


def watch(spark: SparkSession, args: argparse.Namespace) -> None:
    """Messages to alerts, until stopped (or, with `--once`, until all present ones are read).

    Sinks of messages get a JSON text per alert. `--table` also stores the alerts, from the same stream;
    `--rejects` stores the messages that could not be read, and `--ledger` the sums of every message
    for `repair`.
    """
    source = read_stream(spark, args.source_format, options(args.source_option))
    parsed = messages.parse_messages(source)
    stream = alerts.risk_stream(parsed, args.watermark, args.width, args.slide)
    trigger = {"availableNow": True} if args.once else None
    to, started = options(args.option), []
    if args.table:
        started.append(alerts.start_feed(
            stream, args.table, args.checkpoint, args.format, to, args.mode, trigger
        ))
    else:
        encoded = alerts.encode_alerts(stream) if args.format in ("kafka", "text") else stream
        started.append(alerts.start(encoded, args.format, args.checkpoint, args.mode, trigger, to))
    if args.rejects:
        started.append(alerts.start(
            messages.reject_messages(source), "text", f"{args.rejects}-state", "append", trigger,
            {"path": args.rejects},
        ))
    if args.ledger:
        windows = repair.published_windows(parsed, args.watermark, args.width, args.slide)
        started.append(alerts.start(
            windows, "parquet", f"{args.ledger}/windows-state", "append", trigger,
            {"path": f"{args.ledger}/windows"},
        ))
        started.append(repair.start_ledger(
            parsed, f"{args.ledger}/panes", f"{args.ledger}/panes-state", args.slide, trigger
        ))
    for query in started:
        query.awaitTermination()


def mend(spark: SparkSession, args: argparse.Namespace) -> None:
    """Alerts of all closed windows with their late messages, from what `watch --ledger` has stored."""
    empty = messages.parse_messages(spark.createDataFrame([], "value string"))
    published = read_parquet(spark, f"{args.source}/windows")
    ledger = repair.read_ledger(spark, f"{args.source}/panes", empty, args.slide)
    closed = repair.closed_until(ledger, args.watermark)
    late = repair.late_sums(published, ledger, closed, args.width, args.slide)
    write_parquet(alerts_of_sums(repair.repaired(published, late)), args.target)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="faultline")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, *, source: bool = True, target: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__)
        sub.set_defaults(run=run)
        if source:
            sub.add_argument("--source", required=True)
            sub.add_argument("--city", action="store_true", help="CSV files with a city column")
            if run is not clean:
                sub.add_argument("--source-format", choices=["parquet", "csv"], default="parquet")
        if target:
            sub.add_argument("--target", required=True)
        return sub

    sub = job(clean)
    sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    sub.add_argument("--rejects")
    job(hourly)
    sub = job(aggregate)
    sub.add_argument("--entity")
    sub = job(precursors)
    sub.add_argument("--entity")
    sub.add_argument("--key")
    sub.add_argument("--frame-seconds", type=int, default=3600)
    job(land)
    sub = job(publish)
    sub.add_argument("--table", choices=list(TABLES), required=True)
    sub.add_argument("--first")
    sub.add_argument("--last")
    sub.add_argument("--entity")
    sub.add_argument("--frame-seconds", type=int, default=3600)
    sub = job(replay, target=False)
    sub.add_argument("--files-per-trigger", type=int)
    sub.add_argument("--every")
    sub.add_argument("--checkpoint")
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--option", action="append", default=[])
    sub.add_argument("--laps", type=int, default=1)
    sub.add_argument("--lap-seconds", type=int, default=0)
    sub = job(watch, source=False, target=False)
    sub.add_argument("--source-format", default="kafka")
    sub.add_argument("--source-option", action="append", default=[])
    sub.add_argument("--format", default="console")
    sub.add_argument("--option", action="append", default=[])
    sub.add_argument("--mode", choices=["append", "update", "complete"], default="append")
    sub.add_argument("--checkpoint")
    sub.add_argument("--table")
    sub.add_argument("--rejects")
    sub.add_argument("--ledger")
    sub.add_argument("--once", action="store_true")
    windows = [sub, job(mend)]
    for sub in windows:
        sub.add_argument("--watermark", default="10 minutes")
        sub.add_argument("--width", default="5 minutes")
        sub.add_argument("--slide", default="1 minute")
    return top


def main(arguments: Sequence[str], spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = spark or build_session(f"faultline-{args.job}")
    with scratch(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
