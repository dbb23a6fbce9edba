from __future__ import annotations

import random

from pyspark.sql import functions as F

from faultline.functions.ordering import total_before
from faultline.operators.peaks import entity_ranking
from helpers import readings


def test_totals_over_ranges_equal_a_running_sum(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.random(), 0.5]), rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v double, n long").repartition(7)
    order = [F.desc_nulls_last("v"), F.asc("k")]
    got = {r.k: r.before for r in total_before(df, order, F.col("n"), "before").collect()}
    total, expected = 0, {}
    for k, v, n in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])):
        expected[k] = total
        total += n
    assert got == expected
    assert total_before(df.limit(0), order, F.col("n"), "before").count() == 0


def test_ranks_with_ties_across_ranges(spark):
    """200 entities, most of which share a figure, and some without a value."""
    rng = random.Random(4)
    rows = []
    for i in range(200):
        flags, value = rng.choice([1, 1, 2, 5]), rng.choice([None, 3.0, 3.0, rng.random() * 9, float("nan")])
        rows += [(j, f"e{i}", True, value, 1.0) for j in range(flags)]
    ranking = entity_ranking(readings(spark, rows))
    found = {r.ville: r for r in ranking.collect()}
    counts = {e: sum(r[1] == e for r in rows) for e in found}
    values = {e: next(r[3] for r in rows if r[1] == e) for e in found}

    def place(v):
        return (2, 0) if v is None else (0, 0) if v != v else (1, -v)

    for e, r in found.items():
        assert r.rang_frequence == 1 + sum(n > counts[e] for n in counts.values())
        assert r.rang_intensite == 1 + sum(place(v) < place(values[e]) for v in values.values())
    plan = ranking._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
