"""Sliding-window statistics, risk levels and alert texts, for batch and streaming frames alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.columns import COLUMNS, PANES, Columns, pane_sums
from faultline.functions.timeparts import duration_seconds

# --- fixed values: risk levels, their cuts and the alert texts ---------------------------------
HIGH = "ÉLEVÉ"
MODERATE = "MODÉRÉ"
LOW = "FAIBLE"
NORMAL = "NORMAL"


@dataclass(frozen=True)
class RiskRules:
    """Cuts of the risk levels; every comparison is strict."""

    high_variation: float = 0.02
    high_mean: float = 1.05
    moderate_max: float = 1.08
    low_mean: float = 1.06
    low_variation: float = 0.01
    pattern_variation: float = 0.04
    pattern_mean: float = 1.08


HIGH_TEXT = "⚠️ ALERTE RISQUE ÉLEVÉ - "
MODERATE_TEXT = "⚠️ RISQUE MODÉRÉ - "
LOW_TEXT = "ℹ️ Risque faible - "
MEAN_LABEL = "Tension moy: "
MAX_LABEL = "Tension max: "
STABLE_LABEL = "Tension stable: "
VARIATION_LABEL = " - Variation: "
TREMORS_LABEL = " - Secousses: "

ALERT_COLUMNS = [
    "window",
    "tension_avg",
    "tension_variation",
    "nb_secousses",
    "max_magnitude",
    "risk_level",
    "alert_message",
]
# -----------------------------------------------------------------------------------------------

RULES = RiskRules()


def sliding_stats(
    df: DataFrame, width: str = "5 minutes", slide: str = "1 minute", cols: Columns = COLUMNS
) -> DataFrame:
    """Stress, tremors and largest magnitude per sliding window.

    In batch, readings are first summed up per slide and only these sums are put into their
    windows, so a reading is not copied once per window it falls into. A stream, or a width that is
    no multiple of the slide, puts the readings themselves into the windows.
    """
    if not df.isStreaming and duration_seconds(width) % duration_seconds(slide) == 0:
        df, cols = pane_sums(df, slide, cols=cols), PANES
    return df.groupBy(F.window(cols.time, width, slide)).agg(*_statistics(cols))


def _statistics(cols: Columns) -> list[Column]:
    return [
        cols.stress_mean_exact().alias("tension_avg"),
        cols.stress_max().alias("tension_max"),
        cols.stress_min().alias("tension_min"),
        cols.flagged().alias("nb_secousses"),
        cols.value_max().alias("max_magnitude"),
    ]


def risk_level(stats: DataFrame, rules: RiskRules = RULES) -> DataFrame:
    """Add `tension_variation` and `risk_level`; the first matching rule wins."""
    variation, mean = F.col("tension_variation"), F.col("tension_avg")
    high = (variation > rules.high_variation) & (mean > rules.high_mean)
    moderate = (F.col("tension_max") > rules.moderate_max) | (F.col("nb_secousses") > 0)
    low = (mean > rules.low_mean) & (variation < rules.low_variation)
    level = F.when(high, HIGH).when(moderate, MODERATE).when(low, LOW).otherwise(NORMAL)
    return stats.withColumn("tension_variation", F.col("tension_max") - F.col("tension_min")).withColumn(
        "risk_level", level
    )


def _figure(name: str) -> Column:
    """Three decimals as text."""
    return F.coalesce(F.round(name, 3).cast("string"), F.lit(""))


def alert_message(df: DataFrame) -> DataFrame:
    """Add `alert_message`: the figures behind the level, null at the normal level."""
    tremors = F.coalesce(F.col("nb_secousses").cast("string"), F.lit(""))
    texts = {
        HIGH: [
            F.lit(HIGH_TEXT),
            F.lit(MEAN_LABEL),
            _figure("tension_avg"),
            F.lit(VARIATION_LABEL),
            _figure("tension_variation"),
            F.lit(TREMORS_LABEL),
            tremors,
        ],
        MODERATE: [
            F.lit(MODERATE_TEXT),
            F.lit(MAX_LABEL),
            _figure("tension_max"),
            F.lit(TREMORS_LABEL),
            tremors,
        ],
        LOW: [F.lit(LOW_TEXT), F.lit(STABLE_LABEL), _figure("tension_avg")],
    }
    message = F.lit(None).cast("string")
    for level, parts in texts.items():
        message = F.when(F.col("risk_level") == level, F.concat(*parts)).otherwise(message)
    return df.withColumn("alert_message", message)


def risk_alerts(
    df: DataFrame,
    width: str = "5 minutes",
    slide: str = "1 minute",
    rules: RiskRules = RULES,
    cols: Columns = COLUMNS,
) -> DataFrame:
    """Sliding windows with their risk level and alert text."""
    alerts = alert_message(risk_level(sliding_stats(df, width, slide, cols), rules))
    return alerts.select(*ALERT_COLUMNS)


def alerts_of_sums(sums: DataFrame, rules: RiskRules = RULES) -> DataFrame:
    """The same from sums that were kept per `window`, one row or several."""
    stats = sums.groupBy("window").agg(*_statistics(PANES))
    return alert_message(risk_level(stats, rules)).select(*ALERT_COLUMNS)


def false_positives(alerts: DataFrame) -> DataFrame:
    """Windows above the normal level that hold no tremor."""
    return alerts.filter((F.col("risk_level") != NORMAL) & (F.col("nb_secousses") == 0))


def precursor_patterns(alerts: DataFrame, rules: RiskRules = RULES) -> DataFrame:
    """Add one flag per pattern that tends to come before tremors."""
    return alerts.withColumns(
        {
            "hausse_rapide": F.col("tension_variation") > rules.pattern_variation,
            "tension_elevee": F.col("tension_avg") > rules.pattern_mean,
            "secousses_presentes": F.col("nb_secousses") > 0,
        }
    )
