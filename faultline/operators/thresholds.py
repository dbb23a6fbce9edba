"""The magnitude above which a reading is a major event, overall or per entity."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.columns import COLUMNS, Columns
from faultline.functions.ordering import total_before
from faultline.session import attach, estimated_bytes, stage

# Values in the sample that brackets a rank, and how many standard errors of the rank the bracket has
# on either side.
SAMPLE = 200_000
ERRORS = 5

# Where the sample misses the rank: bins per pass and entity, and how many passes narrow the search
# after the one by powers of two.
BINS = 65_536
NARROWING = 1


def _octave(value: Column) -> Column:
    """A number per sign and power of two that never falls as the value rises. Infinities, zero and
    NaN, which ranks above all others, have numbers of their own."""
    power = F.floor(F.log2(F.abs(value))) + 2000
    return (
        F.when(F.isnan(value), 9000)
        .when(F.abs(value) == float("inf"), F.signum(value).cast("long") * 8000)
        .when(value == 0, 0)
        .otherwise(F.when(value > 0, power).otherwise(-power))
    )


def magnitude_threshold(
    df: DataFrame, q: float = 0.9, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """The smallest value with at least a share `q` of the (entity's) non-null values at or below.

    One row with `seuil_magnitude`, null for empty input; with `entity`, one row per entity. NaN
    ranks above infinity, and nothing lies above it.

    The value is exact. Sketches of all tasks would have to meet in one task, and a sort would
    shuffle every value. Instead a bounded sample brackets the rank, and one scan counts the values
    below the bracket and each value inside it (combined before the shuffle); the rank is then found
    in these counts. If the bracket misses the rank of an entity, or the size of the input is not
    known, one pass counts values by sign and power of two, the next ones in equal bins inside one of
    them, and the bin takes the place of the bracket: two scans, or at most five.
    """
    keys = [entity] if entity else []
    values = df.filter(F.col(cols.value).isNotNull()).select(*keys, F.col(cols.value).alias("v"))
    if entity:
        values = values.filter(F.col(entity).isNotNull())
    size = estimated_bytes(values)
    counted = None
    if size is not None:
        # A value takes eight bytes, less where it is stored well; the sample is then the larger.
        share = min(1.0, 8 * SAMPLE / max(size, 1))
        bracket = _bracket(values.sample(share, seed=7), keys, q)
        # Without entities it is a scalar subquery of the scan that counts.
        counted = _counted(values, stage(bracket) if entity else bracket, entity)
        inside, rows = _found(counted, keys, q)
    if counted is None or not inside:
        counted = _counted(values, _narrowed(values, entity, q), entity)
        rows = counted.limit(BINS + 1).count()
    threshold = _at_rank(counted, keys, q, rows <= BINS)
    if entity:
        return threshold
    # Empty input has one row too.
    return threshold.agg(F.max("seuil_magnitude").alias("seuil_magnitude"))


def _rank(q: float, total: str = "total") -> Column:
    """In decimals: a product of doubles may land just above a whole rank."""
    return F.greatest(F.ceil(F.lit(Decimal(str(q))) * F.col(total)), F.lit(1))


def _bracket(sample: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Values below and above the rank, null where the sample has none so far out."""
    whole = Window.partitionBy(*keys)
    spread = ERRORS * F.sqrt(F.col("m") * (q * (1 - q))) + 1
    return (
        sample.withColumns(
            {
                "nth": F.row_number().over(whole.orderBy("v")),
                "m": F.count("v").over(whole),
            }
        )
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("nth") <= F.col("m") * q - spread, F.col("v"))).alias("lo"),
            F.min(F.when(F.col("nth") >= F.col("m") * q + spread, F.col("v"))).alias("hi"),
        )
    )


def _counted(values: DataFrame, bracket: DataFrame, entity: str | None) -> DataFrame:
    """How often each value inside the bracket occurs, and how many lie on its sides (-1 and 1)."""
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    sided = attach(values, bracket, entity).withColumn("side", side)
    keys = [entity] if entity else []
    return stage(
        sided.groupBy(*keys, "side", F.when(F.col("side") == 0, F.col("v")).alias("v")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )


def _found(counted: DataFrame, keys: list[str], q: float) -> tuple[bool, int]:
    """Whether the bracket of every entity holds its rank, and the number of counts."""
    sums = counted.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("side") < 0, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("inside"),
        F.count(F.lit(1)).alias("rows"),
    )
    rank = _rank(q)
    outside = (rank <= F.col("below")) | (rank > F.col("below") + F.col("inside"))
    missed, rows = sums.agg(F.count_if(outside), F.sum("rows")).first()
    return not missed, rows or 0


def _at_rank(counted: DataFrame, keys: list[str], q: float, few: bool) -> DataFrame:
    """The value at the rank, by running totals over the counts: in a window where they are few, else
    over ranges of the values."""
    order, n = [F.col("side"), F.col("v")], F.col("n")
    if few:
        whole = Window.partitionBy(*keys)
        ranked = counted.withColumns(
            {"upto": F.sum("n").over(whole.orderBy(*order)), "total": F.sum("n").over(whole)}
        )
    else:
        # Entities follow each other, so an entity's totals begin where those before it end.
        placed = stage(total_before(counted, [*(F.col(key) for key in keys), *order], n, "before"))
        sums = placed.groupBy(*keys).agg(F.min("before").alias("start"), F.sum("n").alias("total"))
        joined = attach(placed, stage(sums), keys[0] if keys else None)
        ranked = joined.withColumn("upto", F.col("before") - F.col("start") + n)
    rank = _rank(q)
    found = ranked.filter((F.col("upto") >= rank) & (F.col("upto") - n < rank))
    return found.select(*keys, F.col("v").alias("seuil_magnitude"))


def _narrowed(values: DataFrame, entity: str | None, q: float) -> DataFrame:
    """The bin that holds the rank: `lo` and `hi`, per entity."""
    keys = [entity] if entity else []

    def keep_bin(binned: DataFrame, rank: Column) -> DataFrame:
        """The bin that holds the rank, and the rank inside it; at most `BINS` + 1 rows per entity
        reach the window."""
        bins = binned.groupBy(*keys, *(["rang"] if "rang" in binned.columns else []), "bin").agg(
            F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        whole = Window.partitionBy(*keys)
        counted = bins.withColumns(
            {
                "upto": F.sum("n").over(whole.orderBy("bin")),
                "total": F.sum("n").over(whole),
            }
        ).withColumn("rang", rank)
        return counted.filter("upto >= rang AND upto - n < rang").select(
            *keys, (F.col("rang") - (F.col("upto") - F.col("n"))).alias("rang"), "lo", "hi"
        )

    found = stage(keep_bin(values.withColumn("bin", _octave(F.col("v"))), _rank(q)))
    for _ in range(NARROWING):
        if found.filter("lo < hi").isEmpty():
            break
        binned = (
            attach(values, found, entity)
            .filter("v BETWEEN lo AND hi")
            .withColumn("bin", F.when(F.col("lo") == F.col("hi"), 0).otherwise(
                F.width_bucket("v", "lo", "hi", F.lit(BINS))
            ))
        )
        found = stage(keep_bin(binned, F.col("rang")))
    return found.select(*keys, "lo", "hi")


def mark_major(
    df: DataFrame, threshold: DataFrame, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """Add `majeur`: whether the value lies strictly above the threshold.

    Mark before deriving trailing features: the filter on `majeur` can then run below their joins.
    """
    marked = attach(df, threshold, entity)
    major = F.col(cols.value) > F.col("seuil_magnitude")
    return marked.withColumn("majeur", major).drop("seuil_magnitude")


def major_events(
    df: DataFrame, threshold: DataFrame, entity: str | None = None, cols: Columns = COLUMNS
) -> DataFrame:
    """Readings strictly above the threshold (of their entity)."""
    return mark_major(df, threshold, entity, cols).filter("majeur").drop("majeur")
