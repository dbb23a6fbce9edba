from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.operators.precursors import precursor_features
from faultline.operators.thresholds import magnitude_threshold, mark_major
from faultline.plans.inputs import event_readings
from faultline.plans.queries import comparable
from helpers import at, collect, readings

DERIVED = [
    "magnitude_precedente",
    "tension_precedente",
    "nb_secousses_precedentes",
    "magnitude_moy_precedente",
    "tension_moy_precedente",
]


def plain(df, frame_seconds=3600, entity=None, order=("event_id",), include_current=True):
    """The definition: window functions over all readings (of an entity)."""
    keys = [entity] if entity else [F.lit(1)]
    df = df.withColumn("time_seconds", F.unix_timestamp("date"))
    by_time = Window.partitionBy(*keys).orderBy("time_seconds")
    sequence = Window.partitionBy(*keys).orderBy("time_seconds", *order)
    trail = by_time.rangeBetween(-frame_seconds, 0 if include_current else -1)
    # Nothing lies before a reading without a time; a range frame would hold its whole group.
    framed = F.lit(True) if include_current else F.col("time_seconds").isNotNull()
    return df.withColumns(
        {
            "magnitude_precedente": F.lag("magnitude").over(sequence),
            "tension_precedente": F.lag("tension_entre_plaque").over(sequence),
            "nb_secousses_precedentes": F.when(framed, F.count(F.when(F.col("secousse"), 1)).over(trail)).otherwise(0),
            "magnitude_moy_precedente": F.when(framed, F.avg("magnitude").over(trail)),
            "tension_moy_precedente": F.when(framed, F.avg("tension_entre_plaque").over(trail)),
        }
    )


def rounded(df):
    return collect(comparable(df.select("event_id", "time_seconds", *DERIVED)), "event_id")


def noisy(spark, n, span, seed, entities=("a", "b", None)):
    """Readings with ties, gaps, missing values, missing times and one crowded second."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        t = rng.choice([rng.randrange(span), 50_000, rng.randrange(0, span, 3600), None, span * 20])
        value = None if rng.random() < 0.1 else round(rng.random() * 9, 2)
        stress = None if rng.random() < 0.1 else round(1 + rng.random() / 10, 3)
        rows.append((t, rng.choice(entities), rng.choice([True, False, None]), value, stress))
    return readings(spark, rows)


def test_edge_rows(spark):
    df = readings(
        spark,
        [
            (0, "a", True, 1.0, 1.0),
            (0, "a", True, 3.0, 1.0),
            (3600, "a", False, 5.0, 1.0),
            (3601, "a", True, 7.0, 1.0),
            (None, "a", True, 9.0, 1.0),
        ],
    )
    rows = precursor_features(df, key="event_id").orderBy("event_id").collect()
    assert [r["nb_secousses_precedentes"] for r in rows] == [2, 2, 2, 1, 1]
    assert [r["magnitude_moy_precedente"] for r in rows] == [2, 2, 3, 6, 9]
    assert [r["magnitude_precedente"] for r in rows] == [9, 1, 3, 5, None]


@pytest.mark.parametrize("entity", [None, "ville"])
@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize(
    "frame, bucket, key_slice", [(3600, 86_400, 10_000_000), (600, 600, 7), (7, 50, 1), (90_000, 3600, 40)]
)
def test_equals_plain_windows(spark, monkeypatch, entity, include_current, frame, bucket, key_slice):
    monkeypatch.setattr("faultline.operators.precursors.KEY_SLICE", key_slice)
    df = noisy(spark, 400, 200_000, seed=frame)
    got = precursor_features(
        df, frame, entity, "event_id", bucket_seconds=bucket, include_current=include_current
    )
    assert rounded(got) == rounded(plain(df, frame, entity, include_current=include_current))


@pytest.mark.parametrize("entity", [None, "ville"])
def test_without_integer_key_ties_follow_a_hash(spark, entity):
    df = noisy(spark, 300, 5_000, seed=5).withColumn("nom", F.concat(F.lit("r"), "event_id"))
    for key, parts in (("nom", ["nom"]), (None, df.columns)):
        got = precursor_features(df, entity=entity, key=key)
        expected = plain(df, entity=entity, order=(F.xxhash64(*parts),))
        columns = ["time_seconds", "magnitude", "tension_entre_plaque", "secousse", "ville"]
        # Readings equal in every part of the order may change places.
        assert sorted(map(str, comparable(got.select(*columns, *DERIVED)).collect())) == sorted(
            map(str, comparable(expected.select(*columns, *DERIVED)).collect())
        )


def test_without_previous_the_frame_is_the_same(spark):
    df = noisy(spark, 300, 50_000, seed=2)
    full = precursor_features(df, entity="ville", key="event_id")
    frame = precursor_features(df, entity="ville", key="event_id", previous=False)
    assert collect(frame, "event_id") == collect(full.drop(*DERIVED[:2]), "event_id")


def test_empty_input(spark):
    assert precursor_features(readings(spark, []), key="event_id").count() == 0


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_readings_never_meet_in_one_task(spark, sf_dir):
    """Of the plan without entities, only the edges of the buckets share a partition."""
    plan = executed(precursor_features(event_readings(spark, sf_dir), key="event_id"))
    assert "SinglePartition" not in plan


def test_cells_are_hash_aggregated(spark):
    df = noisy(spark, 10, 100, seed=3).withColumn("nom", F.col("event_id").cast("string"))
    for key in ("event_id", "nom", None):
        assert "SortAggregate" not in executed(precursor_features(df, key=key))


def test_filter_runs_below_the_join(spark, sf_dir):
    df = event_readings(spark, sf_dir)
    marked = mark_major(df, magnitude_threshold(df))
    features = precursor_features(marked, key="event_id", previous=False).filter("majeur")
    plan = executed(features)
    assert "Window [lag" not in plan
    assert "event_id" in plan and "user_id" not in plan


def test_random_64_bit_keys_are_cut_at_their_quantiles(spark, monkeypatch):
    """One second of 40,000 readings whose keys are random, in one dense cluster, and repeated."""
    from faultline.operators import precursors

    monkeypatch.setattr(precursors, "KEY_SLICE", 1000)
    stored = []
    stage_table = precursors.stage_table
    monkeypatch.setattr(precursors, "stage_table", lambda df, name: stored.append((name, stage_table(df, name))) or stored[-1][1])
    rng = random.Random(8)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(20_000)] + [2**62 + i for i in range(20_000)]
    rows = [(key, at(7 if i % 10 else i), "a", True, float(i), 1.0) for i, key in enumerate(keys)]
    df = spark.createDataFrame(rows, "event_id long, date timestamp_ntz, ville string, secousse boolean, magnitude double, tension_entre_plaque double").repartition(8)
    got = precursor_features(df, key="event_id")
    assert rounded(got) == rounded(plain(df))
    sizes = dict(stored)["slices"].groupBy("_second", "_slice", "_part").count().collect()
    assert 30 <= len(sizes) <= 60 and max(r["count"] for r in sizes) < 2500


def test_equal_keyless_readings_of_a_second_are_divided(spark, monkeypatch):
    from faultline.operators import precursors

    monkeypatch.setattr(precursors, "KEY_SLICE", 5000)
    stored = []
    stage_table = precursors.stage_table
    monkeypatch.setattr(precursors, "stage_table", lambda df, name: stored.append((name, stage_table(df, name))) or stored[-1][1])
    same = spark.range(0, 100_000, numPartitions=16).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:07' AS date", "'a' AS ville", "true AS secousse", "2.5D AS magnitude", "1.5D AS tension_entre_plaque"
    )
    others = readings(spark, [(3, "a", True, 9.0, 1.0), (7, "a", False, 4.0, 1.0), (8, "a", True, 5.0, 2.0)]).drop("event_id")
    rows = precursor_features(same.unionByName(others)).groupBy("magnitude", "magnitude_precedente").count().collect()
    found = {(r[0], r[1]): r[2] for r in rows}
    assert sum(found.values()) == 100_003 and found[2.5, 2.5] == 99_999
    assert found[9.0, None] == 1 and (5.0, 2.5) in found or (5.0, 4.0) in found
    sizes = dict(stored)["slices"].groupBy("_slice", "_part").count().collect()
    assert len(sizes) <= 40 and max(r["count"] for r in sizes) <= 7000


@pytest.mark.parametrize("entity", [None, "ville"])
def test_conditions_by_second_equal_those_of_the_readings(spark, entity):
    from faultline.operators.precursors import conditions_before, precursor_conditions

    df = noisy(spark, 400, 50_000, seed=11)
    marked = mark_major(df, magnitude_threshold(df, 0.7, entity), entity)
    features = precursor_features(marked, entity=entity, previous=False)
    expected = precursor_conditions(features, entity, df.select(entity) if entity else None)
    got = conditions_before(marked, entity=entity)
    order = [entity] if entity else []
    assert collect(comparable(got.select(expected.columns)), *order) == collect(comparable(expected), *order)
    # The one join attaches the thresholds.
    assert executed(got).count("Join") == (1 if entity else 0)
    empty = conditions_before(marked.limit(0), entity=entity).collect()
    assert [r["nombre_evenements_majeurs"] for r in empty] == ([] if entity else [0])
