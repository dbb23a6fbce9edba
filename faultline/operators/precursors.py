"""What came before each reading: the previous reading, and a trailing time frame.

A window over all readings in time order would put every reading (of an entity) into one task. Here
the readings are first summed up per second, since all readings of one second share one frame:

1. readings -> seconds: one row per entity and second, with its sums and its last reading;
2. seconds -> trailing frame: running sums per entity and block of one frame length. A block has at
   most two rows per second, however many readings it holds; the last reading before a second is found
   in windows over these rows too;
3. the frame goes back to the readings by entity and second; inside a second, the previous reading is
   the one before in the order of the key. A second of very many readings is first cut into slices at
   quantiles of its keys, and the last reading of each slice leads over to the next.

Conditions before major readings need no reading again: the frame of a second counts as often as the
second has major readings.

Readings without a time are one group of their own that precedes all others, as in a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.stats import for_each, ratio
from faultline.columns import COLUMNS, Columns
from faultline.session import attach, stage, stage_table

# Stand in for a missing time or key: before any real one, and exact as a double.
NO_TIME = -(2**50)
NO_KEY = -(2**63)

# A second with more readings is cut, into at most so many slices. Their bounds come from a sample with
# about `SAMPLED` readings per slice of the largest second; results do not depend on it.
KEY_SLICE = 1_000_000
SLICES = 1024
SAMPLED = 100
STEP = 32

SUMS = ["flags", "value_sum", "value_n", "stress_sum", "stress_n"]

FRAME_COLUMNS = ["nb_secousses_precedentes", "magnitude_moy_precedente", "tension_moy_precedente"]

SEQUENCE_COLUMNS = ["magnitude", "tension_entre_plaque", *FRAME_COLUMNS]


def _tie_break(df: DataFrame, key: str | None) -> Column:
    """Order of the readings within one second, as a single number, which `max_by` keeps in a hash
    aggregation: integer keys as they are, else a hash of the key, or of the reading without one."""
    if key and isinstance(df.schema[key].dataType, T.IntegralType):
        return F.coalesce(F.col(key).cast("bigint"), F.lit(NO_KEY))
    atomic = [field.name for field in df.schema if isinstance(field.dataType, T.AtomicType)]
    return F.xxhash64(*([key] if key else atomic))


def _placed(df: DataFrame, entity: str | None, cols: Columns) -> tuple[DataFrame, list[str]]:
    """Readings with their second and, where asked for, an entity that equals itself also if null."""
    rows = df.withColumn("time_seconds", F.unix_timestamp(cols.time)).withColumn(
        "_second", F.coalesce("time_seconds", F.lit(NO_TIME))
    )
    if not entity:
        return rows, []
    name = F.coalesce(F.concat(F.lit("="), F.col(entity).cast("string")), F.lit(""))
    return rows.withColumn("_entity", name), ["_entity"]


def _sums(cols: Columns) -> list[Column]:
    return [
        F.count_if(cols.flag).alias("flags"),
        F.sum(cols.value).alias("value_sum"),
        F.count(cols.value).alias("value_n"),
        F.sum(cols.stress).alias("stress_sum"),
        F.count(cols.stress).alias("stress_n"),
    ]


def _last(cols: Columns) -> list[Column]:
    return [
        F.max_by(cols.value, "_order").alias("value"),
        F.max_by(cols.stress, "_order").alias("stress"),
    ]


def precursor_features(
    df: DataFrame,
    frame_seconds: int = 3600,
    entity: str | None = None,
    key: str | None = None,
    bucket_seconds: int = 86_400,
    include_current: bool = True,
    previous: bool = True,
    cols: Columns = COLUMNS,
) -> DataFrame:
    """Add `time_seconds`, the previous reading's value and stress, and trailing-frame statistics.

    The frame holds the last `frame_seconds` up to and including the second of the reading; without
    `include_current`, only the seconds before it (none, for a reading without a time). Of readings
    with equal keys in one second any may come first. `previous=False` leaves out the previous
    reading, for callers that need the frame only.
    """
    rows, keys = _placed(df, entity, cols)
    at = [*keys, "_second"]
    if not previous:
        seconds = rows.groupBy(*at).agg(*_sums(cols))
        frames = _trailing(seconds, keys, frame_seconds, bucket_seconds, include_current, False)
        return rows.join(frames, at).select(*df.columns, "time_seconds", *FRAME_COLUMNS)

    rows = rows.withColumn("_order", _tie_break(df, key))
    seconds = stage_table(
        rows.groupBy(*at).agg(*_sums(cols), *_last(cols), F.count(F.lit(1)).alias("n")), "seconds"
    )
    frames = _trailing(seconds, keys, frame_seconds, bucket_seconds, include_current, True)
    crowded = seconds.filter(F.col("n") > KEY_SLICE).select(*at, F.col("n").alias("_crowd"))
    if crowded.isEmpty():
        linked = _linked(rows.join(frames, at), at, cols)
    else:
        # Where a reading was read tells equal ones apart.
        told = attach(rows.withColumn("_task", F.spark_partition_id()), crowded, at)
        sliced, cells = _sliced(told, at, crowded, frames, cols)
        plain = told.filter(F.col("_crowd").isNull()).join(frames, at)
        linked = _linked(plain, at, cols).unionByName(
            _linked(sliced.join(cells, [*at, "_slice", "_part"]), [*at, "_slice", "_part"], cols),
            allowMissingColumns=True,
        )
    return linked.select(
        *df.columns, "time_seconds", "magnitude_precedente", "tension_precedente", *FRAME_COLUMNS
    )


def _linked(rows: DataFrame, within: list[str], cols: Columns) -> DataFrame:
    """Add the previous reading: the one before in the order, or the last of what lies before."""
    before = F.lag(F.struct(cols.value, cols.stress)).over(
        Window.partitionBy(*within).orderBy("_order")
    )
    return rows.withColumn("_before", before).withColumns(
        {
            "magnitude_precedente": _first_known("_before", cols.value, "_earlier.value"),
            "tension_precedente": _first_known("_before", cols.stress, "_earlier.stress"),
        }
    )


def _sliced(
    told: DataFrame, at: list[str], crowded: DataFrame, frames: DataFrame, cols: Columns
) -> tuple[DataFrame, DataFrame]:
    """The readings of crowded seconds with a slice, and one row per slice with the last reading before
    it and the frame.

    A slice holds the keys between two neighbouring bounds. A key that is a bound twice fills a slice of
    its own; its readings come in any order, so they are divided by the task that cut them. The readings
    are stored with their slices: a lost task cannot cut them anew.
    """
    dense = told.filter(F.col("_crowd").isNotNull())
    most = crowded.agg(F.max("_crowd")).first()[0]
    sample = dense.sample(min(1.0, SAMPLED * SLICES / most), seed=7)
    second = Window.partitionBy(*at)
    # Bounds lie some number of sampled keys apart: for `SLICES` slices, or fewer of `KEY_SLICE` rows.
    apart = F.ceil(F.col("_m") / F.least(F.lit(SLICES), F.ceil(F.col("_crowd") / KEY_SLICE)))
    bounds = (
        sample.withColumns(
            {
                "_nth": F.row_number().over(second.orderBy("_order")),
                "_m": F.count(F.lit(1)).over(second),
            }
        )
        .filter(F.col("_nth") % apart == 0)
        .groupBy(*at)
        # At most `SLICES` numbers.
        .agg(F.sort_array(F.collect_list("_order")).alias("_bounds"))
        .withColumn("_steps", F.filter("_bounds", lambda b, i: (i + 1) % STEP == 0))
    )

    def below(bound: Column) -> Column:
        return bound < F.col("_order")

    none = F.array().cast("array<bigint>")
    cut = attach(dense, stage(bounds), at).withColumns(
        {"_bounds": F.coalesce("_bounds", none), "_steps": F.coalesce("_steps", none)}
    )
    step = F.size(F.filter("_steps", below)) * STEP
    cut = cut.withColumn("_step", step).withColumn(
        "_slice",
        F.col("_step") + F.size(F.filter(F.slice("_bounds", F.col("_step") + 1, F.lit(STEP)), below)),
    )
    own = (F.get("_bounds", F.col("_slice")) == F.col("_order")) & (
        F.get("_bounds", F.col("_slice") + 1) == F.col("_order")
    )
    part = F.when(F.coalesce(own, F.lit(False)), F.col("_task")).otherwise(-1)
    sliced = stage_table(
        cut.withColumn("_part", part).drop("_bounds", "_steps", "_step"), "slices"
    )
    lasts = sliced.groupBy(*at, "_slice", "_part").agg(*_last(cols))
    before = F.lag(F.struct("value", "stress")).over(second.orderBy("_slice", "_part"))
    found = lasts.withColumn("_near", before).drop("value", "stress").join(frames, at)
    cells = found.withColumn("_earlier", F.coalesce("_near", "_earlier")).drop("_near")
    return sliced, cells


def _first_known(near: str, field: str, far: str) -> Column:
    """The field of the near struct if there is a near reading (its value may be null), else `far`."""
    return F.when(F.col(near).isNotNull(), F.col(near)[field]).otherwise(F.col(far))


def _trailing(
    seconds: DataFrame,
    keys: list[str],
    frame_seconds: int,
    bucket_seconds: int,
    include_current: bool,
    previous: bool,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Trailing statistics of every second, with `previous` also the last earlier reading; other columns
    of `seconds` go along if they are `carried`.

    Time is cut into blocks of one frame length. The frame of a second is then the start of its own
    block up to it, and the end of the block before. Every second takes part in its own block and,
    moved on by one frame length, in the next: there the readings of the block before that are
    still in the frame are those not before it. Both parts are running sums, so the work does not
    grow with the length of the frame.
    """
    per_bucket = max(bucket_seconds // frame_seconds, 1)
    placed = (
        seconds.withColumn("_moved", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_at", F.col("_second") + F.col("_moved") * frame_seconds)
        .withColumn("_block", F.floor(F.col("_at") / frame_seconds))
        .withColumn("_bucket", F.floor(F.col("_block") / per_bucket))
    )
    own = F.col("_moved") == 0
    reading = F.struct("value", "stress") if previous else None

    if previous:
        # The last reading before this second, if it lies in the same bucket of blocks.
        in_bucket = Window.partitionBy(*keys, "_bucket")
        earlier = in_bucket.orderBy("_block", "_at").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumns(
            {
                "_earlier": F.last(F.when(own, reading), ignorenulls=True).over(earlier),
                "_end": F.max(F.when(own, F.col("_at"))).over(in_bucket),
            }
        )

    in_block = Window.partitionBy(*keys, "_bucket", "_block")
    until = in_block.orderBy("_at").rangeBetween(
        Window.unboundedPreceding, 0 if include_current else -1
    )
    since = in_block.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)

    def total(name: str) -> Column:
        here = F.sum(F.when(own, F.col(name))).over(until)
        before = F.sum(F.when(~own, F.col(name))).over(since)
        return F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))

    framed = placed.withColumns({f"_{name}": total(name) for name in SUMS}).filter(own)
    statistics = [
        F.col("_flags").alias("nb_secousses_precedentes"),
        ratio(F.col("_value_sum"), F.col("_value_n")).alias("magnitude_moy_precedente"),
        ratio(F.col("_stress_sum"), F.col("_stress_n")).alias("tension_moy_precedente"),
    ]
    if not previous:
        return framed.select(*keys, "_second", *carried, *statistics)

    # The first second of a bucket follows the last one of the nearest earlier bucket that has any.
    # Only these two seconds of each bucket meet in one window; the others stay in their buckets.
    edge = F.col("_earlier").isNull() | (F.col("_second") == F.col("_end"))
    across = Window.partitionBy(*keys, F.when(~edge, F.col("_bucket"))).orderBy("_second")
    linked = framed.withColumn("_earlier", F.coalesce("_earlier", F.lag(reading).over(across)))
    return linked.select(*keys, "_second", *carried, "_earlier", *statistics)


def conditions_before(
    marked: DataFrame,
    frame_seconds: int = 3600,
    entity: str | None = None,
    bucket_seconds: int = 86_400,
    cols: Columns = COLUMNS,
) -> DataFrame:
    """Mean trailing conditions at the readings marked `majeur`, and their number.

    The major readings are counted in the aggregation that sums up the seconds, and the frame of a
    second counts as often as it has any: one scan, and no join of readings. Every entity has a row, with
    the number 0 if it has no major reading.
    """
    rows, keys = _placed(marked, entity, cols)
    names = [entity] if entity else []
    seconds = rows.groupBy(*keys, *names, "_second").agg(
        *_sums(cols), F.count_if("majeur").alias("majors")
    )
    frames = _trailing(
        seconds, keys, frame_seconds, bucket_seconds, True, False, [*names, "majors"]
    )

    def mean(name: str) -> Column:
        weight = F.when(F.col(name).isNotNull(), F.col("majors"))
        return ratio(F.sum(F.col(name) * weight), F.sum(weight))

    return frames.groupBy(*names).agg(
        mean("nb_secousses_precedentes").alias("moy_secousses_avant"),
        mean("magnitude_moy_precedente").alias("moy_magnitude_avant"),
        mean("tension_moy_precedente").alias("moy_tension_avant"),
        F.coalesce(F.sum("majors"), F.lit(0)).alias("nombre_evenements_majeurs"),
    )


def precursor_conditions(
    features: DataFrame, entity: str | None = None, entities: DataFrame | None = None
) -> DataFrame:
    """The same as `conditions_before`, from features that are there already.

    Entities without any are in the result, with the
    number 0, if `entities` names them.
    """
    keys = [entity] if entity else []
    found = (
        features.filter("majeur")
        .groupBy(*keys)
        .agg(
            F.avg("nb_secousses_precedentes").alias("moy_secousses_avant"),
            F.avg("magnitude_moy_precedente").alias("moy_magnitude_avant"),
            F.avg("tension_moy_precedente").alias("moy_tension_avant"),
            F.count(F.lit(1)).alias("nombre_evenements_majeurs"),
        )
    )
    return for_each(entities, found, entity).fillna(0, ["nombre_evenements_majeurs"])


def tremor_sequences(
    features: DataFrame, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """The flagged readings with their trailing conditions."""
    keys = [entity] if entity else []
    return features.filter(cols.flag).select(
        *keys, cols.time, cols.value, cols.stress, *FRAME_COLUMNS
    )
