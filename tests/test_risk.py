from __future__ import annotations

import pytest

from faultline.operators import risk
from faultline.plans.inputs import event_readings
from faultline.columns import COLUMNS
from helpers import collect, readings

STATS = "tension_avg double, tension_max double, tension_min double, nb_secousses long, max_magnitude double"


def leveled(spark, rows):
    return risk.alert_message(risk.risk_level(spark.createDataFrame(rows, STATS)))


@pytest.mark.parametrize(
    "mean, high, low, tremors, level",
    [
        (1.06, 1.0625, 1.03125, 0, risk.HIGH),
        (1.05, 1.0625, 1.03125, 0, risk.NORMAL),
        (1.0500000000000003, 1.0625, 1.03125, 0, risk.HIGH),
        (1.0500000004, 1.1, 1.05, 0, risk.HIGH),
        (1.04, 1.05, 1.04, 1, risk.MODERATE),
        (1.07, 1.08, 1.08, 0, risk.LOW),
        (1.07, 1.0800001, 1.08, 0, risk.MODERATE),
        (1.06, 1.06, 1.06, 0, risk.NORMAL),
        (None, None, None, 0, risk.NORMAL),
    ],
)
def test_levels(spark, mean, high, low, tremors, level):
    row = leveled(spark, [(mean, high, low, tremors, 0.0)]).first()
    assert row["risk_level"] == level
    assert (row["alert_message"] is None) == (level == risk.NORMAL)


def test_variation_cut_is_strict(spark):
    stats = spark.createDataFrame([(1.07, 0.02, 0.0, 0, 0.0)], STATS)
    assert risk.risk_level(stats).first()["risk_level"] == risk.NORMAL


def test_messages(spark):
    rows = [(1.0625, 1.0625, 1.03125, 2, 1.0), (1.0, 1.09, 1.09, 0, 1.0), (1.0654, 1.07, 1.07, 0, 1.0)]
    assert [r["alert_message"] for r in leveled(spark, rows).collect()] == [
        "⚠️ ALERTE RISQUE ÉLEVÉ - Tension moy: 1.063 - Variation: 0.031 - Secousses: 2",
        "⚠️ RISQUE MODÉRÉ - Tension max: 1.09 - Secousses: 0",
        "ℹ️ Risque faible - Tension stable: 1.065",
    ]


def test_a_missing_figure_leaves_the_rest_of_the_message(spark):
    row = leveled(spark, [(None, None, None, 3, 1.0)]).first()
    assert row["alert_message"] == "⚠️ RISQUE MODÉRÉ - Tension max:  - Secousses: 3"


def test_presummed_windows_equal_direct_windows(spark, sf_dir):
    """A width that is no multiple of the slide takes the direct way; both agree where both apply."""
    df = event_readings(spark, sf_dir)
    summed = risk.sliding_stats(df, "4 minutes", "2 minutes")
    direct = df.groupBy(risk.F.window("date", "4 minutes", "2 minutes")).agg(
        risk.F.max("tension_entre_plaque").alias("tension_max"),
        risk.F.count_if("secousse").alias("nb_secousses"),
    )
    columns = ["window", "tension_max", "nb_secousses"]
    assert collect(summed.select(*columns), "window") == collect(direct.select(*columns), "window")
    uneven = risk.sliding_stats(readings(spark, [(0, "a", True, 1.0, 1.0)]), "5 minutes", "2 minutes")
    assert uneven.count() in (2, 3)


def test_findings(spark):
    df = readings(spark, [(0, "a", False, 0.0, 1.09), (1, "a", False, 0.0, 1.14), (7200, "a", True, 2.0, 1.0)])
    alerts = risk.risk_alerts(df, cols=COLUMNS)
    assert risk.false_positives(alerts).count() == 5
    patterns = risk.precursor_patterns(alerts).orderBy("window").collect()
    assert (patterns[0]["hausse_rapide"], patterns[0]["tension_elevee"], patterns[0]["secousses_presentes"]) == (
        True,
        True,
        False,
    )


@pytest.mark.parametrize(
    "values, mean",
    [
        ([1.003, 1.097, 1.05, 1.049, 1.051], 1.05),
        ([1.0500000000000003], 1.0500000000000003),
        ([1e27, 1e27], 1e27),
        ([1e-25, 3e-25], (1e-25 + 3e-25) / 2),
        ([1.0, float("inf")], float("inf")),
        ([None, 2.0], 2.0),
        ([None], None),
    ],
)
def test_means_are_exact_in_any_order_and_lose_no_value(spark, values, mean):
    """In panes of a minute and directly; values that no decimal holds are summed as doubles."""
    for order in (values, values[::-1]):
        df = readings(spark, [(60 * i, "a", False, 0.0, x) for i, x in enumerate(order)])
        for slide in ("10 minutes", "1 minute"):
            found = risk.sliding_stats(df, "10 minutes", slide).orderBy("window").collect()
            assert mean in [row["tension_avg"] for row in found]
