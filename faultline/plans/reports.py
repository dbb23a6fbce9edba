"""Named sets of results over one table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faultline.operators.correlate import correlation_pairs, describe_columns
from faultline.operators.peaks import critical_windows, hours_of, peak_windows
from faultline.operators.precursors import (
    precursor_conditions,
    precursor_features,
    tremor_sequences,
)
from faultline.operators.rollups import hour_profile, stress_trend, window_stats
from faultline.operators.thresholds import magnitude_threshold, mark_major
from faultline.columns import COLUMNS, PANES, Columns, pane_sums
from faultline.session import stage_table
from faultline.sources import readers, sinks


def aggregation_report(
    df: DataFrame, entity: str | None = None, ordered: bool = False, cols: Columns = COLUMNS
) -> dict[str, DataFrame]:
    """Rollups and peaks; with `entity`, also its profile and critical periods.

    The threshold is the same for all entities. All tables are made of quarter hours, so the
    readings are summed up per quarter hour once, and every table is computed from these sums.
    `ordered` sorts every table for reading; for storing, the sort is a shuffle without use.
    """
    marked = mark_major(df, magnitude_threshold(df, cols=cols), cols=cols)
    keys = ["majeur", entity] if entity else ["majeur"]
    panes = stage_table(pane_sums(marked, "15 minutes", keys, cols), "quarter-hours")
    major = panes.filter("majeur")
    tables = {
        "agg_horaire": (hour_profile(panes, cols=PANES), ["heure"]),
        "agg_15min": (window_stats(panes, "15 minutes", cols=PANES), ["window.start"]),
        "pics_activite": (peak_windows(major, cols=PANES), ["-nombre_evenements", "window.start"]),
        "tendances_tension": (stress_trend(panes, cols=PANES), ["window.start"]),
    }
    if entity:
        tables["agg_ville_heure"] = (hour_profile(panes, entity, PANES), [entity, "heure"])
        tables["periodes_critiques"] = (
            critical_windows(major, entity, cols=PANES),
            ["-nombre_evenements", "window.start", entity],
        )
    return {name: _sorted(df, order) if ordered else df for name, (df, order) in tables.items()}


def precursor_report(
    df: DataFrame,
    frame_seconds: int = 3600,
    entity: str | None = None,
    key: str | None = None,
    ordered: bool = False,
    target: str | None = None,
    cols: Columns = COLUMNS,
) -> dict[str, DataFrame]:
    """What came before the major events; with `entity`, for every entity in the same plans.

    Each entity then has its own threshold and its own trailing frames. The features are written once,
    to the folder `target` if there is one (as `sinks.save_tables` would) and else to the shared folder;
    all results read the columns they need from there.
    """
    threshold = magnitude_threshold(df, entity=entity, cols=cols)
    marked = mark_major(df, threshold, entity, cols)
    features = precursor_features(marked, frame_seconds, entity, key, cols=cols)
    if target:
        path = sinks.save_tables({"precurseurs": features}, target)["precurseurs"]
        features = readers.read_parquet(df.sparkSession, path, features.schema)
    else:
        features = stage_table(features, "features")
    sequences = tremor_sequences(features, entity, cols)
    keys = [entity] if entity else []
    # The features are stored, so this reads one of their columns.
    entities = features.select(entity) if entity else None
    statistics = describe_columns(sequences, entity=entity, entities=entities)
    tables = {
        "seuil": (threshold, keys),
        "precurseurs": (features, [*keys, "time_seconds"]),
        "conditions": (precursor_conditions(features, entity, entities), keys),
        "sequences": (sequences, [*keys, cols.time]),
        "statistiques": (statistics, [*keys, "colonne"]),
        "correlations": (correlation_pairs(sequences, entity=entity), [*keys, "gauche", "droite"]),
        "heures_majeures": (hours_of(features.filter("majeur"), entity, cols), [*keys, "heure"]),
    }
    return {name: _sorted(df, order) if ordered and order else df for name, (df, order) in tables.items()}


def _sorted(df: DataFrame, order: list[str]) -> DataFrame:
    columns = [name.removeprefix("-") for name in order]
    return df.orderBy(*columns, ascending=[not name.startswith("-") for name in order])
