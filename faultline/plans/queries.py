"""Every operator as a query over the `events` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.timeparts import flatten_window
from faultline.operators import clean, correlate, peaks, precursors, risk, rollups, thresholds
from faultline.plans.daily import publish_days
from faultline.plans.inputs import EVENT_ENTITY, EVENT_KEY, event_readings, event_texts
from faultline.plans.reports import aggregation_report, precursor_report
from faultline.schemas import (
    CITY_READINGS_TABLE,
    HOURLY_STATS_TABLE,
    RAW_CITY_READINGS,
    RAW_READINGS,
    READINGS_TABLE,
)
from faultline.session import scratch_dir
from faultline.sources import catalog, readers, sinks
from faultline.streaming import alerts, messages, repair, upserts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, since sums differ in their last bits, and times without a zone.

    Rounding goes through a decimal, so that a half-way value does not depend on its last bit.
    Values that no decimal holds (NaN, infinities, very large ones) stay as they are.
    """

    def cell(name: str, kind: str) -> Column:
        if kind == "double":
            exact = F.col(name).try_cast("decimal(38,12)")
            return F.coalesce(F.round(exact, 6).cast("double"), F.col(name)).alias(name)
        return F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)

    return df.select(*(cell(name, kind) for name, kind in df.dtypes))


# --- cleaning, files and tables ----------------------------------------------------------------


@query
def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(clean.clean_readings(event_texts(spark, sf_dir)))


@query
def rejected_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clean.rejects(event_texts(spark, sf_dir))
    return found.select("event_id", F.array_join("rejected", ",").alias("rejected"))


@query
def csv_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text through CSV files: written, scanned with an all-text schema, cleaned."""
    path = scratch_dir(spark, "csv-readings")
    sinks.write_csv(event_texts(spark, sf_dir).select(*RAW_CITY_READINGS.names), path)
    return comparable(clean.clean_readings(readers.read_csv(spark, path, RAW_CITY_READINGS)))


@query
def external_csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text through CSV files under an external table that types the columns."""
    path = scratch_dir(spark, "csv-table")
    sinks.write_csv(event_texts(spark, sf_dir).select(*RAW_CITY_READINGS.names), path)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return comparable(
        clean.clean_readings(catalog.external_csv(spark, table, path, CITY_READINGS_TABLE))
    )


@query
def external_csv_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without cities."""
    path = scratch_dir(spark, "csv-general")
    sinks.write_csv(event_texts(spark, sf_dir).select(*RAW_READINGS.names), path)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return comparable(clean.clean_readings(catalog.external_csv(spark, table, path, READINGS_TABLE)))


@query
def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics published as Parquet and read through an external table."""
    path = scratch_dir(spark, "hourly-stats")
    sinks.write_parquet(rollups.hourly_stats(event_readings(spark, sf_dir)), path)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return comparable(catalog.external_parquet(spark, table, path, HOURLY_STATS_TABLE))


# --- rollups -----------------------------------------------------------------------------------


@query
def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.hourly_stats(event_readings(spark, sf_dir)))


@query
def quarter_hour_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.window_stats(event_readings(spark, sf_dir), "15 minutes")
    return comparable(flatten_window(stats))


@query
def stress_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flatten_window(rollups.stress_trend(event_readings(spark, sf_dir))))


@query
def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.hour_profile(event_readings(spark, sf_dir)))


@query
def entity_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.hour_profile(event_readings(spark, sf_dir), EVENT_ENTITY))


@query
def tremors_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.flag_counts(event_readings(spark, sf_dir), EVENT_ENTITY)


@query
def mean_nonzero_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.mean_above(event_readings(spark, sf_dir)))


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    return rollups.row_counts({"lectures": readings.drop("ville"), "lectures_villes": readings})


# --- thresholds, peaks and rankings ------------------------------------------------------------


@query
def major_threshold_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.magnitude_threshold(event_readings(spark, sf_dir))


@query
def major_threshold_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.magnitude_threshold(event_readings(spark, sf_dir), entity=EVENT_ENTITY)


@query
def activity_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    found = peaks.activity_peaks(readings, thresholds.magnitude_threshold(readings))
    return comparable(flatten_window(found))


@query
def critical_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    found = peaks.critical_periods(readings, thresholds.magnitude_threshold(readings), EVENT_ENTITY)
    return comparable(flatten_window(found))


@query
def major_event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    return peaks.major_event_hours(readings, thresholds.magnitude_threshold(readings))


@query
def major_event_hours_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    threshold = thresholds.magnitude_threshold(readings, entity=EVENT_ENTITY)
    return peaks.major_event_hours(readings, threshold, EVENT_ENTITY)


@query
def entity_peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peaks.peak_hour(major_event_hours_entity(spark, sf_dir), EVENT_ENTITY)


@query
def quiet_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(peaks.quiet_periods(rollups.hourly_stats(event_readings(spark, sf_dir))))


@query
def stress_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(peaks.extremes(rollups.hour_profile(event_readings(spark, sf_dir))))


@query
def entity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(peaks.entity_ranking(event_readings(spark, sf_dir), EVENT_ENTITY))


@query
def top_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three busiest half hours: the limit is the result."""
    readings = event_readings(spark, sf_dir)
    found = peaks.activity_peaks(readings, thresholds.magnitude_threshold(readings))
    return comparable(flatten_window(peaks.top_windows(found, 3)))


@query
def busiest_quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three busiest quarter hours of every entity: the limit is the result."""
    stats = rollups.window_stats(event_readings(spark, sf_dir), "15 minutes", entity=EVENT_ENTITY)
    found = peaks.top_windows(stats, 3, "nombre_observations", EVENT_ENTITY)
    return comparable(flatten_window(found))


# --- precursors and correlations ---------------------------------------------------------------


def _features(
    spark: SparkSession, sf_dir: str, entity: str | None, previous: bool = False
) -> DataFrame:
    return precursors.precursor_features(
        event_readings(spark, sf_dir), entity=entity, key=EVENT_KEY, previous=previous
    )


def _conditions(spark: SparkSession, sf_dir: str, entity: str | None) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    threshold = thresholds.magnitude_threshold(readings, entity=entity)
    marked = thresholds.mark_major(readings, threshold, entity)
    return comparable(precursors.conditions_before(marked, entity=entity))


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_readings(spark, sf_dir).select(EVENT_ENTITY)


@query
def precursor_features_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_features(spark, sf_dir, None, previous=True))


@query
def precursor_features_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_features(spark, sf_dir, EVENT_ENTITY, previous=True))


@query
def precursor_conditions_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conditions(spark, sf_dir, None)


@query
def precursor_conditions_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conditions(spark, sf_dir, EVENT_ENTITY)


@query
def tremor_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(precursors.tremor_sequences(_features(spark, sf_dir, None)))


@query
def sequence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = precursors.tremor_sequences(_features(spark, sf_dir, None))
    return comparable(correlate.describe_columns(sequences))


@query
def sequence_stats_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = precursors.tremor_sequences(_features(spark, sf_dir, EVENT_ENTITY), EVENT_ENTITY)
    entities = _entities(spark, sf_dir)
    return comparable(
        correlate.describe_columns(sequences, entity=EVENT_ENTITY, entities=entities)
    )


@query
def correlation_pairs_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = precursors.tremor_sequences(_features(spark, sf_dir, None))
    return comparable(correlate.correlation_pairs(sequences))


@query
def correlation_pairs_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten pairs of every entity, also the weak ones."""
    sequences = precursors.tremor_sequences(_features(spark, sf_dir, EVENT_ENTITY), EVENT_ENTITY)
    entities = _entities(spark, sf_dir)
    return comparable(
        correlate.correlation_pairs(
            sequences, entity=EVENT_ENTITY, min_abs=None, entities=entities
        )
    )


# --- reports -----------------------------------------------------------------------------------


@query
def published_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregation report with its entity tables, stored and read back: rows per table."""
    report = aggregation_report(event_readings(spark, sf_dir), EVENT_ENTITY)
    paths = sinks.save_tables(report, scratch_dir(spark, "report"))
    return rollups.row_counts(
        {name: readers.read_parquet(spark, path) for name, path in paths.items()}
    )


def report_table(table: str) -> Query:
    """One table of the aggregation report, computed from its quarter hours."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = aggregation_report(event_readings(spark, sf_dir), EVENT_ENTITY)[table]
        return comparable(flatten_window(df) if "window" in df.columns else df)

    return build


QUERIES["report_hour_profile"] = report_table("agg_horaire")
QUERIES["report_quarter_hour_stats"] = report_table("agg_15min")
QUERIES["report_activity_peaks"] = report_table("pics_activite")
QUERIES["report_stress_trend"] = report_table("tendances_tension")
QUERIES["report_entity_hour_profile"] = report_table("agg_ville_heure")
QUERIES["report_critical_periods"] = report_table("periodes_critiques")


@query
def precursor_report_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The precursor report of every entity in one set of plans: rows per table."""
    readings = event_readings(spark, sf_dir)
    return rollups.row_counts(precursor_report(readings, entity=EVENT_ENTITY, key=EVENT_KEY))


def precursor_table(table: str, entity: str | None) -> Query:
    """One table of the precursor report, general or with every entity."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings = event_readings(spark, sf_dir)
        return comparable(precursor_report(readings, entity=entity, key=EVENT_KEY)[table])

    return build


for suffix, name in (("global", None), ("entity", EVENT_ENTITY)):
    QUERIES[f"report_conditions_{suffix}"] = precursor_table("conditions", name)
    QUERIES[f"report_sequence_stats_{suffix}"] = precursor_table("statistiques", name)
    QUERIES[f"report_correlations_{suffix}"] = precursor_table("correlations", name)
    QUERIES[f"report_major_hours_{suffix}"] = precursor_table("heures_majeures", name)


# --- risk --------------------------------------------------------------------------------------


@query
def sliding_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flatten_window(risk.sliding_stats(event_readings(spark, sf_dir))))


@query
def risk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows per risk level."""
    levels = risk.risk_level(risk.sliding_stats(event_readings(spark, sf_dir)))
    return levels.groupBy("risk_level").agg(F.count(F.lit(1)).alias("nombre_fenetres"))


@query
def risk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flatten_window(risk.risk_alerts(event_readings(spark, sf_dir))))


@query
def false_positive_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk.false_positives(risk.risk_alerts(event_readings(spark, sf_dir)))
    return comparable(flatten_window(found))


@query
def precursor_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk.precursor_patterns(risk.risk_alerts(event_readings(spark, sf_dir)))
    return comparable(
        flatten_window(found).select(
            "window_start", "hausse_rapide", "tension_elevee", "secousses_presentes"
        )
    )


# --- messages and streams ----------------------------------------------------------------------


@query
def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.encode_messages(event_readings(spark, sf_dir))
    return comparable(messages.parse_messages(sent))


@query
def replayed_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two laps of the same readings, 60 days apart, in hourly windows."""
    sent = messages.encode_messages(
        event_readings(spark, sf_dir), laps=2, lap_seconds=60 * 86_400
    )
    received = messages.parse_messages(sent).withColumnRenamed("event_time", "date")
    return comparable(rollups.hourly_stats(received))


@query
def stream_risk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written as text, streamed through the alert query, and the stored alerts read back.

    Append mode emits a window once the watermark has passed it, so a closing message follows the
    readings. The readings are one batch: none of them is late.
    """
    base = scratch_dir(spark, "stream-alerts")
    readings = event_readings(spark, sf_dir)
    sent = messages.encode_messages(readings)
    closing = messages.closing_message(readings, after_seconds=3600)
    messages.write_messages(sent.unionAll(closing), "text", {"path": f"{base}/messages"})

    source = readers.read_stream(spark, "text", {"path": f"{base}/messages"})
    stream = flatten_window(alerts.risk_stream(messages.parse_messages(source)))
    alerts.start(
        stream,
        "parquet",
        checkpoint=f"{base}/checkpoint",
        trigger={"availableNow": True},
        options={"path": f"{base}/alerts"},
    ).awaitTermination()
    return comparable(readers.read_parquet(spark, f"{base}/alerts", stream.schema))


@query
def stream_complete_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert stream in complete mode, each batch stored under its number; the last one counts."""
    base = scratch_dir(spark, "stream-complete")
    sent = messages.encode_messages(event_readings(spark, sf_dir))
    messages.write_messages(sent, "text", {"path": f"{base}/messages"})
    source = readers.read_stream(spark, "text", {"path": f"{base}/messages"})
    stream = flatten_window(alerts.risk_stream(messages.parse_messages(source)))
    upserts.start_upserts(
        stream, f"{base}/alerts", f"{base}/checkpoint", "complete", {"availableNow": True}
    ).awaitTermination()
    keys = ["window_start", "window_end"]
    return comparable(upserts.read_upserts(spark, f"{base}/alerts", stream.schema, keys))


@query
def stream_late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flagged readings arrive after the watermark has closed their windows, and are added to what the
    stream has published: the alerts of the batch."""
    base = scratch_dir(spark, "stream-late")
    readings = event_readings(spark, sf_dir)
    flagged = F.coalesce(F.col("secousse"), F.lit(False))
    closing = messages.closing_message(readings, after_seconds=3600)

    def arrive(sent: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Write messages, let both streams read them, and return what they have stored so far."""
        messages.write_messages(sent, "text", {"path": f"{base}/messages"})
        source = readers.read_stream(spark, "text", {"path": f"{base}/messages"})
        parsed = messages.parse_messages(source)
        windows = repair.published_windows(parsed)
        now = {"availableNow": True}
        alerts.start(
            windows, "parquet", f"{base}/windows-state", "append", now, {"path": f"{base}/windows"}
        ).awaitTermination()
        repair.start_ledger(
            parsed, f"{base}/ledger", f"{base}/ledger-state", trigger=now
        ).awaitTermination()
        published = readers.read_parquet(spark, f"{base}/windows", windows.schema)
        return published, repair.read_ledger(spark, f"{base}/ledger", parsed)

    arrive(messages.encode_messages(readings.filter(~flagged)).unionAll(closing))
    published, ledger = arrive(messages.encode_messages(readings.filter(flagged)))
    late = repair.late_sums(published, ledger, repair.closed_until(ledger))
    found = risk.alerts_of_sums(repair.repaired(published, late))
    return comparable(flatten_window(found))


@query
def paced_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two laps as in `replayed_laps`, sent as streams of some files per trigger."""
    base = scratch_dir(spark, "paced-replay")
    readings = event_readings(spark, sf_dir)
    sinks.write_parquet(readings.repartition(4, "event_id"), f"{base}/readings")
    messages.replay_paced(
        spark, f"{base}/readings", readings.schema, f"{base}/checkpoint", "text",
        {"path": f"{base}/messages"}, laps=2, lap_seconds=60 * 86_400, files_per_trigger=2,
    )
    laps = (spark.read.text(messages.lap_folder(f"{base}/messages", lap)) for lap in range(2))
    sent = reduce(DataFrame.unionAll, laps)
    received = messages.parse_messages(sent).withColumnRenamed("event_time", "date")
    return comparable(rollups.hourly_stats(received))


@query
def published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics published by day; every second week is then computed once more by itself."""
    base = scratch_dir(spark, "days")
    sinks.write_days(event_readings(spark, sf_dir), f"{base}/readings", "date")
    publish_days(spark, f"{base}/readings", f"{base}/hours", "horaire")
    first, last = spark.read.parquet(f"{base}/hours").agg(F.min("jour"), F.max("jour")).first()
    for start in range(7, (last - first).days + 1 if first else 0, 14):
        span = first + timedelta(days=start), first + timedelta(days=start + 6)
        publish_days(spark, f"{base}/readings", f"{base}/hours", "horaire", *span)
    return comparable(readers.read_parquet(spark, f"{base}/hours").drop("jour", "debut"))


@query
def published_day_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing frames of every reading published by day, the last day by a run of its own that looks back
    over one frame."""
    base = scratch_dir(spark, "day-frames")
    sinks.write_days(event_readings(spark, sf_dir), f"{base}/readings", "date")
    publish_days(spark, f"{base}/readings", f"{base}/frames", "precurseurs")
    last = spark.read.parquet(f"{base}/frames").agg(F.max("jour")).first()[0]
    if last:
        publish_days(spark, f"{base}/readings", f"{base}/frames", "precurseurs", last, last)
    return comparable(readers.read_parquet(spark, f"{base}/frames").drop("jour", "debut"))
