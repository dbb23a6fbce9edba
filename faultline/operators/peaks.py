"""Where and when major events cluster, and rankings over rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.thresholds import major_events
from faultline.columns import COLUMNS, Columns
from faultline.functions.ordering import total_before
from faultline.session import stage


def peak_windows(major: DataFrame, width: str = "30 minutes", cols: Columns = COLUMNS) -> DataFrame:
    """Number, mean and largest value of major events per window."""
    return major.groupBy(F.window(cols.time, width)).agg(
        cols.count().alias("nombre_evenements"),
        cols.value_mean().alias("magnitude_moyenne"),
        cols.value_max().alias("magnitude_max"),
    )


def critical_windows(
    major: DataFrame, entity: str = "ville", width: str = "1 hour", cols: Columns = COLUMNS
) -> DataFrame:
    """Number, largest value and mean stress of major events per entity and window."""
    return major.groupBy(entity, F.window(cols.time, width)).agg(
        cols.count().alias("nombre_evenements"),
        cols.value_max().alias("magnitude_max"),
        cols.stress_mean().alias("tension_moyenne"),
    )


def activity_peaks(
    df: DataFrame, threshold: DataFrame, width: str = "30 minutes", cols: Columns = COLUMNS
) -> DataFrame:
    """Readings above the threshold per window."""
    return peak_windows(major_events(df, threshold, cols=cols), width, cols)


def critical_periods(
    df: DataFrame,
    threshold: DataFrame,
    entity: str = "ville",
    width: str = "1 hour",
    cols: Columns = COLUMNS,
) -> DataFrame:
    """Readings above one threshold shared by all entities, per entity and window."""
    return critical_windows(major_events(df, threshold, cols=cols), entity, width, cols)


def major_event_hours(
    df: DataFrame, threshold: DataFrame, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """Major events per hour of day; with `entity`, each against its own threshold."""
    return hours_of(major_events(df, threshold, entity, cols), entity, cols)


def hours_of(
    major: DataFrame, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """Major events per hour of day (and entity)."""
    keys = [entity] if entity else []
    return major.groupBy(*keys, F.hour(cols.time).alias("heure")).agg(
        cols.count().alias("nombre_evenements")
    )


def peak_hour(hours: DataFrame, entity: str = "ville") -> DataFrame:
    """Per entity, the hour of `major_event_hours` with most events; the earliest hour wins ties."""
    best = F.max_by(F.col("heure"), F.struct(F.col("nombre_evenements"), -F.col("heure")))
    return (
        hours.filter("heure IS NOT NULL")
        .groupBy(entity)
        .agg(best.alias("heure"), F.max("nombre_evenements").alias("nombre_evenements"))
    )


def quiet_periods(stats: DataFrame) -> DataFrame:
    """Rows of a rollup without a flagged reading."""
    return stats.filter("nombre_secousses = 0")


def extremes(profile: DataFrame, column: str = "tension_moyenne", at: str = "heure") -> DataFrame:
    """One row: where the column of a rollup is largest and smallest (smallest `at` wins ties)."""
    present = profile.filter(F.col(column).isNotNull() & F.col(at).isNotNull())
    # The row with the extreme value comes first in the order of (value, at).
    low = F.min(F.struct(F.col(column), F.col(at)))
    high = F.min(F.struct(-F.col(column), F.col(at)))
    return present.agg(
        F.max(column).alias(f"{column}_max"),
        high[at].alias(f"{at}_max"),
        F.min(column).alias(f"{column}_min"),
        low[at].alias(f"{at}_min"),
    )


def entity_ranking(df: DataFrame, entity: str = "ville", cols: Columns = COLUMNS) -> DataFrame:
    """Entities ranked by number of flagged readings and by largest value.

    Ranks are totals over the distinct figures, cut into ranges: no task sees all entities, and any
    number of entities may share a figure.
    """
    totals = stage(
        df.groupBy(entity).agg(
            cols.flagged().alias("nombre_secousses"), cols.value_max().alias("magnitude_max")
        )
    )
    ranked = _with_rank(totals, "nombre_secousses", "rang_frequence")
    return _with_rank(ranked, "magnitude_max", "rang_intensite")


def _with_rank(totals: DataFrame, figure: str, name: str) -> DataFrame:
    """Add the rank by falling `figure`, nulls last; equal figures share a rank."""
    each = totals.groupBy(F.col(figure).alias("_figure")).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.desc_nulls_last("_figure")]
    ranks = total_before(each, order, F.col("_n"), "_before").select(
        "_figure", (F.col("_before") + 1).cast("int").alias(name)
    )
    joined = totals.join(ranks, totals[figure].eqNullSafe(ranks["_figure"]))
    return joined.select(*totals.columns, name)


def top_windows(
    stats: DataFrame,
    k: int,
    by: str = "nombre_evenements",
    entity: str | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The `k` windows with the largest `by`, overall or per entity; earlier windows win ties.

    Overall, name in `ties` the columns that tell windows of the same time apart, such as entities.
    """
    if entity is None:
        return stats.orderBy(F.desc(by), "window.start", *ties).limit(k)
    order = Window.partitionBy(entity).orderBy(F.desc(by), "window.start")
    ranked = stats.withColumn("rang", F.row_number().over(order))
    return ranked.filter(F.col("rang") <= k)
