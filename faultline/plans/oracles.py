"""The same results in plain SQL over the `events` table, for comparison with every query."""

from __future__ import annotations

from itertools import combinations

MEASURES = ["magnitude", "tension_entre_plaque"]
STAT_MEANS = ["magnitude_moyenne", "magnitude_max", "tension_moyenne"]
TRAILING = ["magnitude_moy_precedente", "tension_moy_precedente"]
FEATURES = [*MEASURES, "magnitude_precedente", "tension_precedente", *TRAILING]
CONDITION_MEANS = ["moy_secousses_avant", "moy_magnitude_avant", "moy_tension_avant"]
FIGURES = ["moyenne", "ecart_type", "minimum", "maximum"]
ALERT_FIGURES = ["tension_avg", "tension_variation", "max_magnitude"]

# Columns given to six decimals, since sums differ in their last bits with the order of the rows.
ROUNDED: dict[str, list[str]] = {
    "clean_readings": MEASURES,
    "csv_readings": MEASURES,
    "external_csv_table": MEASURES,
    "external_table_scan": STAT_MEANS,
    "hourly_stats": STAT_MEANS,
    "quarter_hour_stats": STAT_MEANS,
    "hour_profile": STAT_MEANS,
    "entity_hour_profile": STAT_MEANS,
    "quiet_periods": STAT_MEANS,
    "busiest_quarter_hours": STAT_MEANS,
    "replayed_laps": STAT_MEANS,
    "stress_trend": ["tension_moyenne", "tension_moyenne_secousses"],
    "mean_nonzero_magnitude": ["magnitude_moyenne"],
    "activity_peaks": ["magnitude_moyenne", "magnitude_max"],
    "top_peaks": ["magnitude_moyenne", "magnitude_max"],
    "critical_periods": ["magnitude_max", "tension_moyenne"],
    "stress_extremes": ["tension_moyenne_max", "tension_moyenne_min"],
    "entity_ranking": ["magnitude_max"],
    "precursor_features_global": FEATURES,
    "precursor_features_entity": FEATURES,
    "precursor_conditions_global": CONDITION_MEANS,
    "precursor_conditions_entity": CONDITION_MEANS,
    "tremor_sequences": [*MEASURES, *TRAILING],
    "sequence_stats": FIGURES,
    "sequence_stats_entity": FIGURES,
    "correlation_pairs_global": ["correlation"],
    "correlation_pairs_entity": ["correlation"],
    "sliding_stats": ["tension_avg", "tension_max", "tension_min", "max_magnitude"],
    "risk_alerts": ALERT_FIGURES,
    "false_positive_windows": ALERT_FIGURES,
    "stream_risk_alerts": ALERT_FIGURES,
    "message_roundtrip": MEASURES,
}


def rounded(sql: str, columns: list[str]) -> str:
    """Round through a decimal, so that a half-way value does not depend on its last bit."""
    if not columns:
        return sql
    cells = ", ".join(
        f"CAST(round(CAST({c} AS DECIMAL(38, 12)), 6) AS DOUBLE) AS {c}" for c in columns
    )
    return f"SELECT * REPLACE ({cells}) FROM ({sql})"


READINGS = """
WITH r AS (
  SELECT event_id, ts AS date, event_type AS ville, value >= 50.0 AS secousse, value AS magnitude,
         1.0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 AS tension_entre_plaque
  FROM events
)"""

TEXTS = (
    READINGS
    + """, raw AS (
  SELECT event_id, ville,
         CASE WHEN ville = 'signup' AND magnitude < 5 THEN '2024-13-01 00:00:00'
              ELSE strftime(date, '%Y-%m-%d %H:%M:%S') END AS date,
         CASE WHEN ville IN ('click', 'purchase', 'view') THEN CAST(secousse AS VARCHAR)
              WHEN ville = 'error' THEN 'maybe' END AS secousse,
         CASE WHEN magnitude < 2 THEN 'abc' WHEN magnitude < 4 THEN NULL
              WHEN magnitude < 5 THEN 'NaN' ELSE CAST(magnitude AS VARCHAR) END AS magnitude,
         CAST(tension_entre_plaque AS VARCHAR) AS tension_entre_plaque
  FROM r
), typed AS (
  SELECT event_id, TRY_CAST(date AS TIMESTAMP) AS date, ville,
         TRY_CAST(secousse AS BOOLEAN) AS secousse, TRY_CAST(magnitude AS DOUBLE) AS magnitude,
         TRY_CAST(tension_entre_plaque AS DOUBLE) AS tension_entre_plaque
  FROM raw
)"""
)

CLEANED = """date, ville, secousse,
       CASE WHEN isnan(magnitude) THEN 0 ELSE coalesce(magnitude, 0) END AS magnitude,
       CASE WHEN isnan(tension_entre_plaque) THEN 0
                  ELSE coalesce(tension_entre_plaque, 0) END AS tension_entre_plaque"""

STATS = """count(*) AS nombre_observations,
       count(CASE WHEN secousse THEN 1 END) AS nombre_secousses,
       avg(magnitude) AS magnitude_moyenne,
       max(magnitude) AS magnitude_max,
       avg(tension_entre_plaque) AS tension_moyenne"""

HOURLY = f"""SELECT {STATS},
       strftime(time_bucket(INTERVAL 1 hour, date), '%Y-%m-%d %H:%M:%S') AS window_start
FROM r GROUP BY window_start"""

PROFILE = f"""SELECT CAST(hour(date) AS INTEGER) AS heure, {STATS} FROM r GROUP BY heure"""

# Thresholds and the readings above them: against one threshold, and each city against its own.
MAJOR = (
    READINGS
    + """, t AS (SELECT quantile_disc(magnitude, 0.9) AS seuil FROM r),
m AS (SELECT r.* FROM r, t WHERE magnitude > seuil)"""
)
MAJOR_ENTITY = (
    READINGS
    + """, t AS (SELECT ville, quantile_disc(magnitude, 0.9) AS seuil FROM r GROUP BY ville),
m AS (SELECT r.* FROM r JOIN t USING (ville) WHERE magnitude > seuil)"""
)
PEAKS = """, p AS (
  SELECT time_bucket(INTERVAL 30 minutes, date) AS window_start,
         time_bucket(INTERVAL 30 minutes, date) + INTERVAL 30 minutes AS window_end,
         count(*) AS nombre_evenements, avg(magnitude) AS magnitude_moyenne,
         max(magnitude) AS magnitude_max
  FROM m GROUP BY ALL
)"""
ENTITY_HOURS = """, h AS (
  SELECT ville, CAST(hour(date) AS INTEGER) AS heure, count(*) AS nombre_evenements
  FROM m GROUP BY ALL
)"""


def features(entity: bool, base: str = READINGS) -> str:
    """Trailing frame and previous reading as plain window functions over all readings."""
    part = "PARTITION BY ville " if entity else ""
    return f"""{base}, s AS (
  SELECT *, CAST(floor(epoch(date)) AS BIGINT) AS time_seconds FROM r
), f AS (
  SELECT *,
         lag(magnitude) OVER seq AS magnitude_precedente,
         lag(tension_entre_plaque) OVER seq AS tension_precedente,
         count(CASE WHEN secousse THEN 1 END) OVER trail AS nb_secousses_precedentes,
         avg(magnitude) OVER trail AS magnitude_moy_precedente,
         avg(tension_entre_plaque) OVER trail AS tension_moy_precedente
  FROM s
  WINDOW seq AS ({part}ORDER BY time_seconds NULLS FIRST, event_id),
         trail AS ({part}ORDER BY time_seconds NULLS FIRST
                   RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)
)"""


FEATURE_COLUMNS = """event_id, date, ville, secousse, magnitude,
       tension_entre_plaque, time_seconds,
       magnitude_precedente,
       tension_precedente, nb_secousses_precedentes,
       magnitude_moy_precedente,
       tension_moy_precedente"""

CONDITIONS = """avg(nb_secousses_precedentes) FILTER (magnitude > seuil) AS moy_secousses_avant,
       avg(magnitude_moy_precedente) FILTER (magnitude > seuil) AS moy_magnitude_avant,
       avg(tension_moy_precedente) FILTER (magnitude > seuil) AS moy_tension_avant,
       count(*) FILTER (magnitude > seuil) AS nombre_evenements_majeurs"""

SEQUENCE = [
    "magnitude",
    "tension_entre_plaque",
    "nb_secousses_precedentes",
    "magnitude_moy_precedente",
    "tension_moy_precedente",
]


def described(entity: bool) -> str:
    key, group = ("ville, ", " GROUP BY ville") if entity else ("", "")
    rows = [
        f"""SELECT {key}'{c}' AS colonne, count({c}) FILTER (secousse) AS nombre,
       avg({c}) FILTER (secousse) AS moyenne, stddev_samp({c}) FILTER (secousse) AS ecart_type,
       CAST(min({c}) FILTER (secousse) AS DOUBLE) AS minimum,
       CAST(max({c}) FILTER (secousse) AS DOUBLE) AS maximum
FROM f{group}"""
        for c in SEQUENCE
    ]
    return f"{features(entity)}\n" + "\nUNION ALL\n".join(rows)


def correlated(entity: bool) -> str:
    """One scan for all ten pairs, then one row per pair."""
    key, group = ("ville, ", " GROUP BY ville") if entity else ("", "")
    pairs = list(combinations(sorted(SEQUENCE), 2))
    cells = ", ".join(f"corr({x}, {y}) FILTER (secousse) AS c{i}" for i, (x, y) in enumerate(pairs))
    rows = [
        f"SELECT {key}'{x}' AS gauche, '{y}' AS droite, "
        f"CASE WHEN isnan(c{i}) THEN NULL ELSE c{i} END AS correlation FROM c"
        for i, (x, y) in enumerate(pairs)
    ]
    return (
        f"{features(entity)}, c AS (SELECT {key}{cells} FROM f{group})\n"
        + "\nUNION ALL\n".join(rows)
    )


SLIDING = (
    READINGS
    + """, w AS (
  SELECT unnest(generate_series(time_bucket(INTERVAL 1 minute, date) - INTERVAL 4 minutes,
                                time_bucket(INTERVAL 1 minute, date),
                                INTERVAL 1 minute)) AS window_start, r.*
  FROM r
), st AS (
  SELECT window_start, window_start + INTERVAL 5 minutes AS window_end,
         CAST(sum(CAST(tension_entre_plaque AS DECIMAL(38, 12))) AS DOUBLE)
           / count(tension_entre_plaque) AS tension_avg,
         max(tension_entre_plaque) AS tension_max,
         min(tension_entre_plaque) AS tension_min,
         max(tension_entre_plaque) - min(tension_entre_plaque) AS tension_variation,
         count(CASE WHEN secousse THEN 1 END) AS nb_secousses, max(magnitude) AS max_magnitude
  FROM w GROUP BY window_start
), lv AS (
  SELECT *, CASE WHEN tension_variation > 0.02 AND tension_avg > 1.05 THEN 'ÉLEVÉ'
                 WHEN tension_max > 1.08 OR nb_secousses > 0 THEN 'MODÉRÉ'
                 WHEN tension_avg > 1.06 AND tension_variation < 0.01 THEN 'FAIBLE'
                 ELSE 'NORMAL' END AS risk_level
  FROM st
)"""
)


def figure(column: str) -> str:
    """Three decimals of the double as it prints, half-way values away from zero."""
    exact = f"CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(CAST(round({exact}, 3) AS DOUBLE) AS VARCHAR)"


ALERTS = (
    SLIDING
    + f""", al AS (
  SELECT window_start, window_end, tension_avg,
         tension_variation, nb_secousses,
         max_magnitude, risk_level,
         CASE risk_level
           WHEN 'ÉLEVÉ' THEN '⚠️ ALERTE RISQUE ÉLEVÉ - Tension moy: ' || {figure("tension_avg")}
                || ' - Variation: ' || {figure("tension_variation")}
                || ' - Secousses: ' || nb_secousses
           WHEN 'MODÉRÉ' THEN '⚠️ RISQUE MODÉRÉ - Tension max: ' || {figure("tension_max")}
                || ' - Secousses: ' || nb_secousses
           WHEN 'FAIBLE' THEN 'ℹ️ Risque faible - Tension stable: ' || {figure("tension_avg")}
         END AS alert_message
  FROM lv
)"""
)


def counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS nom_table, count(*) AS nombre_lignes FROM ({sql})"
        for name, sql in tables.items()
    )


def bucket(width: str) -> str:
    return f"time_bucket(INTERVAL {width}, date)"


RESULTS: dict[str, str] = {
    "clean_readings": f"{TEXTS}\nSELECT event_id, {CLEANED} FROM typed",
    "rejected_readings": f"""{TEXTS}
SELECT event_id, rejected FROM (
  SELECT raw.event_id, concat_ws(',',
           CASE WHEN raw.date IS NOT NULL AND typed.date IS NULL THEN 'date' END,
           CASE WHEN raw.secousse IS NOT NULL AND typed.secousse IS NULL THEN 'secousse' END,
           CASE WHEN raw.magnitude IS NOT NULL AND typed.magnitude IS NULL THEN 'magnitude' END
         ) AS rejected
  FROM raw JOIN typed USING (event_id)
) WHERE rejected <> ''""",
    "csv_readings": f"{TEXTS}\nSELECT {CLEANED} FROM typed",
    "external_csv_table": f"{TEXTS}\nSELECT {CLEANED} FROM typed",
    "external_table_scan": f"{READINGS}\n{HOURLY}",
    "hourly_stats": f"{READINGS}\n{HOURLY}",
    "quarter_hour_stats": f"""{READINGS}
SELECT {bucket("15 minutes")} AS window_start,
       {bucket("15 minutes")} + INTERVAL 15 minutes AS window_end, {STATS}
FROM r GROUP BY window_start""",
    "stress_trend": f"""{READINGS}
SELECT {bucket("1 hour")} AS window_start, {bucket("1 hour")} + INTERVAL 1 hour AS window_end,
       avg(tension_entre_plaque) AS tension_moyenne,
       avg(CASE WHEN secousse THEN tension_entre_plaque END) AS tension_moyenne_secousses,
       count(CASE WHEN secousse THEN 1 END) AS nombre_secousses
FROM r GROUP BY window_start""",
    "hour_profile": f"{READINGS}\n{PROFILE}",
    "entity_hour_profile": f"""{READINGS}
SELECT ville, CAST(hour(date) AS INTEGER) AS heure, {STATS} FROM r GROUP BY ville, heure""",
    "tremors_per_entity": f"""{READINGS}
SELECT ville, CAST(sum(CASE WHEN secousse THEN 1 ELSE 0 END) AS BIGINT) AS nombre_secousses
FROM r GROUP BY ville""",
    "mean_nonzero_magnitude": f"""{READINGS}
SELECT avg(magnitude) AS magnitude_moyenne FROM r WHERE magnitude > 0""",
    "row_counts": f"""{READINGS}
{counts({"lectures": "SELECT * FROM r", "lectures_villes": "SELECT * FROM r"})}""",
    "major_threshold_global": f"{MAJOR}\nSELECT seuil AS seuil_magnitude FROM t",
    "major_threshold_entity": f"{MAJOR_ENTITY}\nSELECT ville, seuil AS seuil_magnitude FROM t",
    "activity_peaks": f"{MAJOR}{PEAKS}\nSELECT * FROM p",
    "critical_periods": f"""{MAJOR}
SELECT ville, {bucket("1 hour")} AS window_start,
       {bucket("1 hour")} + INTERVAL 1 hour AS window_end, count(*) AS nombre_evenements,
       max(magnitude) AS magnitude_max,
       avg(tension_entre_plaque) AS tension_moyenne
FROM m GROUP BY ville, window_start""",
    "major_event_hours": f"""{MAJOR}
SELECT CAST(hour(date) AS INTEGER) AS heure, count(*) AS nombre_evenements FROM m GROUP BY heure""",
    "major_event_hours_entity": f"{MAJOR_ENTITY}{ENTITY_HOURS}\nSELECT * FROM h",
    "entity_peak_hour": f"""{MAJOR_ENTITY}{ENTITY_HOURS}
SELECT ville, heure, nombre_evenements FROM h
QUALIFY row_number() OVER (PARTITION BY ville ORDER BY nombre_evenements DESC, heure) = 1""",
    "quiet_periods": f"""{READINGS}, q AS ({HOURLY})
SELECT * FROM q WHERE nombre_secousses = 0""",
    "stress_extremes": f"""{READINGS}, p AS (
  SELECT CAST(hour(date) AS INTEGER) AS heure, avg(tension_entre_plaque) AS tension
  FROM r GROUP BY heure
)
SELECT max(tension) AS tension_moyenne_max, arg_max(heure, tension) AS heure_max,
       min(tension) AS tension_moyenne_min, arg_min(heure, tension) AS heure_min
FROM p""",
    "entity_ranking": f"""{READINGS}, c AS (
  SELECT ville, count(CASE WHEN secousse THEN 1 END) AS nombre_secousses,
         max(magnitude) AS magnitude_max
  FROM r GROUP BY ville
)
SELECT *, CAST(rank() OVER (ORDER BY nombre_secousses DESC) AS INTEGER) AS rang_frequence,
       CAST(rank() OVER (ORDER BY magnitude_max DESC) AS INTEGER) AS rang_intensite
FROM c""",
    "top_peaks": f"""{MAJOR}{PEAKS}
SELECT * FROM p ORDER BY nombre_evenements DESC, window_start LIMIT 3""",
    "busiest_quarter_hours": f"""{READINGS}, q AS (
  SELECT ville, {bucket("15 minutes")} AS window_start,
         {bucket("15 minutes")} + INTERVAL 15 minutes AS window_end, {STATS}
  FROM r GROUP BY ville, window_start
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY ville ORDER BY nombre_observations DESC,
                                    window_start) AS INTEGER) AS rang
  FROM q
)
SELECT * FROM k WHERE rang <= 3""",
    "precursor_features_global": f"{features(False)}\nSELECT {FEATURE_COLUMNS} FROM f",
    "precursor_features_entity": f"{features(True)}\nSELECT {FEATURE_COLUMNS} FROM f",
    "precursor_conditions_global": f"""{features(False, MAJOR)}
SELECT {CONDITIONS} FROM f, t""",
    "precursor_conditions_entity": f"""{features(True, MAJOR_ENTITY)}
SELECT ville, {CONDITIONS} FROM f LEFT JOIN t USING (ville) GROUP BY ville""",
    "tremor_sequences": f"""{features(False)}
SELECT date, magnitude,
       tension_entre_plaque, nb_secousses_precedentes,
       magnitude_moy_precedente,
       tension_moy_precedente
FROM f WHERE secousse""",
    "sequence_stats": described(False),
    "sequence_stats_entity": described(True),
    "correlation_pairs_global": f"""SELECT * FROM ({correlated(False)})
WHERE abs(correlation) > 0.3""",
    "correlation_pairs_entity": correlated(True),
    "published_report": f"""{MAJOR}
{counts({
        "agg_horaire": "SELECT DISTINCT hour(date) FROM r",
        "agg_15min": f"SELECT DISTINCT {bucket('15 minutes')} FROM r",
        "pics_activite": f"SELECT DISTINCT {bucket('30 minutes')} FROM m",
        "tendances_tension": f"SELECT DISTINCT {bucket('1 hour')} FROM r",
        "agg_ville_heure": "SELECT DISTINCT ville, hour(date) FROM r",
        "periodes_critiques": f"SELECT DISTINCT ville, {bucket('1 hour')} FROM m",
    })}""",
    "precursor_report_entity": f"""{MAJOR_ENTITY}
{counts({
        "seuil": "SELECT * FROM t",
        "precurseurs": "SELECT * FROM r",
        "conditions": "SELECT DISTINCT ville FROM r",
        "sequences": "SELECT * FROM r WHERE secousse",
        "statistiques": "SELECT DISTINCT ville, unnest(range(5)) FROM r",
    })}
UNION ALL
SELECT 'correlations', count(*) FROM ({correlated(True)}) WHERE abs(correlation) > 0.3
UNION ALL
SELECT 'heures_majeures', count(*) FROM (SELECT DISTINCT ville, hour(date) FROM m)""",
    "sliding_stats": f"""{SLIDING}
SELECT window_start, window_end, tension_avg,
       tension_max, tension_min, nb_secousses,
       max_magnitude
FROM st""",
    "risk_levels": f"""{SLIDING}
SELECT risk_level, count(*) AS nombre_fenetres FROM lv GROUP BY risk_level""",
    "risk_alerts": f"{ALERTS}\nSELECT * FROM al",
    "false_positive_windows": f"""{ALERTS}
SELECT * FROM al WHERE risk_level <> 'NORMAL' AND nb_secousses = 0""",
    "precursor_patterns": f"""{SLIDING}
SELECT window_start, tension_variation > 0.04 AS hausse_rapide,
       tension_avg > 1.08 AS tension_elevee, nb_secousses > 0 AS secousses_presentes
FROM lv""",
    "message_roundtrip": f"""{READINGS}
SELECT strftime(date, '%Y-%m-%d %H:%M:%S') AS timestamp, secousse, magnitude,
       tension_entre_plaque,
       date_trunc('second', date) AS event_time
FROM r""",
    "replayed_laps": f"""WITH r AS (
  SELECT o.* REPLACE (date + lap * INTERVAL 60 days AS date)
  FROM ({READINGS} SELECT * FROM r) o, (SELECT unnest(range(2)) AS lap)
)
{HOURLY}""",
    "stream_risk_alerts": f"{ALERTS}\nSELECT * FROM al",
}

ORACLES = {name: rounded(sql, ROUNDED.get(name, [])) for name, sql in RESULTS.items()}

# The tables of the report hold what the single operators give.
for single in [
    "hour_profile",
    "quarter_hour_stats",
    "activity_peaks",
    "stress_trend",
    "entity_hour_profile",
    "critical_periods",
]:
    ORACLES[f"report_{single}"] = ORACLES[single]

for suffix, stats in (("global", "sequence_stats"), ("entity", "sequence_stats_entity")):
    pairs = ORACLES[f"correlation_pairs_{suffix}"]
    hours = "major_event_hours" if suffix == "global" else "major_event_hours_entity"
    ORACLES[f"report_conditions_{suffix}"] = ORACLES[f"precursor_conditions_{suffix}"]
    ORACLES[f"report_sequence_stats_{suffix}"] = ORACLES[stats]
    ORACLES[f"report_correlations_{suffix}"] = f"SELECT * FROM ({pairs}) WHERE abs(correlation) > 0.3"
    ORACLES[f"report_major_hours_{suffix}"] = ORACLES[hours]

# Streams and tables that are stored in parts give what one computation over all readings gives.
ORACLES["stream_complete_alerts"] = ORACLES["risk_alerts"]
ORACLES["stream_late_repair"] = ORACLES["risk_alerts"]
ORACLES["paced_replay"] = ORACLES["replayed_laps"]
ORACLES["published_days"] = ORACLES["hourly_stats"]
ORACLES["published_day_frames"] = f"""SELECT * EXCLUDE (magnitude_precedente, tension_precedente)
FROM ({ORACLES["precursor_features_global"]})"""
ORACLES["external_csv_general"] = f"SELECT * EXCLUDE (ville) FROM ({ORACLES['external_csv_table']})"
