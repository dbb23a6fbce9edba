"""The columns an operator works on, and how it aggregates them.

Operators name no column and no aggregate of their own: they ask their `Columns`. So the same rollup
runs over readings and over readings that were already summed up per pane of time (`PaneColumns`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.stats import exact, exact_ratio, ratio
from faultline.functions.timeparts import duration_seconds


@dataclass(frozen=True)
class Columns:
    """One row per reading; the defaults are the columns of cleaned readings."""

    time: str = "date"
    flag: str = "secousse"
    value: str = "magnitude"
    stress: str = "tension_entre_plaque"

    def count(self) -> Column:
        return F.count(F.lit(1))

    def flagged(self) -> Column:
        return F.count_if(self.flag)

    def value_mean(self) -> Column:
        return F.avg(self.value)

    def value_max(self) -> Column:
        return F.max(self.value)

    def stress_mean(self) -> Column:
        return F.avg(self.stress)

    def stress_mean_exact(self) -> Column:
        """The mean that is compared with cuts: the same in every order of the rows."""
        held = exact(self.stress)
        return exact_ratio(
            F.try_sum(held), F.count(held), F.sum(self.stress), F.count(self.stress)
        )

    def stress_mean_flagged(self) -> Column:
        return F.avg(F.when(F.col(self.flag), F.col(self.stress)))

    def stress_max(self) -> Column:
        return F.max(self.stress)

    def stress_min(self) -> Column:
        return F.min(self.stress)


@dataclass(frozen=True)
class PaneColumns(Columns):
    """One row per pane of time, as `pane_sums` makes them."""

    time: str = "pane"

    def count(self) -> Column:
        return F.sum("n")

    def flagged(self) -> Column:
        return F.sum("flags")

    def value_mean(self) -> Column:
        return ratio(F.sum("value_sum"), F.sum("value_n"))

    def value_max(self) -> Column:
        return F.max("value_max")

    def stress_mean(self) -> Column:
        return ratio(F.sum("stress_sum"), F.sum("stress_n"))

    def stress_mean_exact(self) -> Column:
        return exact_ratio(
            F.try_sum("stress_exact"),
            F.sum(F.when(F.col("stress_exact").isNotNull(), F.col("stress_exact_n"))),
            F.sum("stress_sum"),
            F.sum("stress_n"),
        )

    def stress_mean_flagged(self) -> Column:
        return ratio(F.sum("flagged_stress_sum"), F.sum("flagged_stress_n"))

    def stress_max(self) -> Column:
        return F.max("stress_max")

    def stress_min(self) -> Column:
        return F.min("stress_min")


COLUMNS = Columns()
PANES = PaneColumns()

# Streamed readings carry the parsed event time under its own name.
STREAM_COLUMNS = Columns(time="event_time")


def pane_sums(
    df: DataFrame,
    width: str,
    keys: Sequence[str] = (),
    cols: Columns = COLUMNS,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Sums of the readings per pane of time (and keys); readings without a time share a null pane.

    Windows and hours made of whole panes can be computed from these rows, which are as many as
    there are panes, however many readings they hold. Unused sums are pruned from the plan.
    """
    seconds = F.unix_timestamp(cols.time)
    start = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(duration_seconds(width))))
    pane = start.cast(df.schema[cols.time].dataType).alias("pane")
    return df.groupBy(*keys, pane).agg(*reading_sums(cols), *extra)


def reading_sums(cols: Columns = COLUMNS) -> list[Column]:
    """What panes and windows keep of their readings: figures that can be added up further."""
    flagged_stress = F.when(F.col(cols.flag), F.col(cols.stress))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(cols.flag).alias("flags"),
        F.sum(cols.value).alias("value_sum"),
        F.count(cols.value).alias("value_n"),
        F.max(cols.value).alias("value_max"),
        F.sum(cols.stress).alias("stress_sum"),
        F.count(cols.stress).alias("stress_n"),
        F.try_sum(exact(cols.stress)).alias("stress_exact"),
        F.count(exact(cols.stress)).alias("stress_exact_n"),
        F.max(cols.stress).alias("stress_max"),
        F.min(cols.stress).alias("stress_min"),
        F.sum(flagged_stress).alias("flagged_stress_sum"),
        F.count(flagged_stress).alias("flagged_stress_n"),
    ]


# Sums that go on adding up; the others are extremes and the exact sum.
ADDED = [
    "n",
    "flags",
    "value_sum",
    "value_n",
    "stress_sum",
    "stress_n",
    "flagged_stress_sum",
    "flagged_stress_n",
]


def merged_sums() -> list[Column]:
    """The sums of several panes or windows together."""
    known = F.when(F.col("stress_exact").isNotNull(), F.col("stress_exact_n"))
    return [
        *(F.sum(name).alias(name) for name in ADDED),
        F.max("value_max").alias("value_max"),
        F.max("stress_max").alias("stress_max"),
        F.min("stress_min").alias("stress_min"),
        F.try_sum("stress_exact").alias("stress_exact"),
        F.coalesce(F.sum(known), F.lit(0)).alias("stress_exact_n"),
    ]
