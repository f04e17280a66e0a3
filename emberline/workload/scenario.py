"""What-if queries over the full feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.clean import clip
from emberline.operators import cleaning as C
from emberline.operators import scenario as X
from emberline.plans import features as P
from emberline.workload import standins as D
from emberline.workload.features import FEATURE_CTES, round_sql, rounded
from emberline.workload.registry import query

SHOWN = [*S.SHIFTED_WEATHER, *S.FIRE, *S.ROLLING]
CTES = f"{D.det_sql('group')}, {D.weather_sql('group')}, {FEATURE_CTES}"
UNIFORM = "(CAST(('0x' || substring(md5(concat_ws('|', province_id, CAST(date AS VARCHAR), '{c}', '42')), 1, 8)) AS UBIGINT) / CAST(4294967296 AS DOUBLE))"


def features(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf, "group"), [F.desc("snapshot_id")])
    return P.daily_features(D.detections(spark, sf, "group"), weather)


def clamped(c: str, expr: str) -> str:
    low, high = S.PHYSICAL_BOUNDS.get(c, (0.0, None))
    inner = f"greatest({expr}, CAST({low} AS DOUBLE))"
    if high is not None:
        inner = f"least({inner}, CAST({high} AS DOUBLE))"
    return f"CASE WHEN {c} IS NOT NULL THEN {inner} END AS {c}"


def scenario_sql(changes: dict[str, str], dry_days: str) -> str:
    cols = ", ".join(clamped(c, changes[c]) for c in SHOWN)
    return f"""WITH {CTES}, shifted AS (SELECT province_id, date, {cols}, {dry_days} AS days_since_rain FROM features)
SELECT province_id, date, days_since_rain, {round_sql(SHOWN, 10)} FROM shifted"""


def by_factor(weather: dict[str, str], fire: str, rolling: str) -> dict[str, str]:
    out = {c: c for c in SHOWN}
    out |= {c: f"{c} * CAST({fire} AS DOUBLE)" for c in S.FIRE}
    out |= {c: f"{c} * CAST({rolling} AS DOUBLE)" for c in S.ROLLING}
    return out | weather


def shown(df):
    return rounded(df.select("province_id", "date", "days_since_rain", *SHOWN), 10)


@query("scenario_drought", scenario_sql(by_factor({
    "precipitation_sum": "precipitation_sum * CAST(0.3 AS DOUBLE)",
    "relative_humidity_2m_mean": "relative_humidity_2m_mean * CAST(0.75 AS DOUBLE)",
    "temperature_2m_max": "temperature_2m_max + CAST(3.5 AS DOUBLE)",
    "temperature_2m_min": "temperature_2m_min + CAST(2.5 AS DOUBLE)"}, "1.35", "1.25"),
    "least(greatest(days_since_rain + 14, 0), 90)"))
def _(spark, sf):
    return shown(X.run_scenario(features(spark, sf), "drought"))


# Magnitude 0.25 adds 3.5 dry days: the half goes to the even neighbour.
@query("round_half_even", f"""WITH {CTES}
SELECT province_id, date, days_since_rain AS before,
  least(greatest(CAST(round_even(days_since_rain + CAST(3.5 AS DOUBLE), 0) AS BIGINT), 0), 90) AS after FROM features""")
def _(spark, sf):
    base = features(spark, sf).withColumn("before", F.col("days_since_rain"))
    return X.run_scenario(base, "drought", 0.25).select("province_id", "date", "before", F.col("days_since_rain").alias("after"))


@query("scenario_wet", scenario_sql(by_factor({
    "precipitation_sum": "precipitation_sum + CAST(50 AS DOUBLE)",
    "relative_humidity_2m_mean": "relative_humidity_2m_mean + CAST(30 AS DOUBLE)",
    "temperature_2m_max": "temperature_2m_max - CAST(5 AS DOUBLE)",
    "temperature_2m_min": "temperature_2m_min - CAST(3 AS DOUBLE)"}, "0", "0.2"), "CAST(0 AS BIGINT)"))
def _(spark, sf):
    return shown(X.run_scenario(features(spark, sf), "wet", 2.0))


@query("scenario_mixed", scenario_sql(
    {c: f"{c} * (CAST(0.85 AS DOUBLE) + CAST(0.3 AS DOUBLE) * {UNIFORM.format(c=c)})" for c in SHOWN}, "days_since_rain"))
def _(spark, sf):
    return shown(X.run_scenario(features(spark, sf), "mixed"))


@query("clamp_bounds", f"""WITH {D.det_sql()}
SELECT event_id, CASE WHEN frp IS NOT NULL THEN least(greatest(frp - 20, 0), 30) END AS clamped FROM det""")
def _(spark, sf):
    return D.detections(spark, sf).select("event_id", clip(F.col("frp") - 20, 0.0, 30.0).alias("clamped"))


@query("shift_summary", f"""WITH {CTES},
long_form AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, avg({c}) AS b, avg({e}) AS a FROM features" for c, e in {
    'temperature_2m_max': 'CASE WHEN temperature_2m_max IS NOT NULL THEN least(temperature_2m_max + 3.5, 50) END', 'temperature_2m_min': 'CASE WHEN temperature_2m_min IS NOT NULL THEN least(temperature_2m_min + 2.5, 40) END',
    'precipitation_sum': 'precipitation_sum * 0.3', 'relative_humidity_2m_mean': 'relative_humidity_2m_mean * 0.75',
    'windspeed_10m_max': 'windspeed_10m_max', 'frp_mean': 'frp_mean * 1.35', 'frp_max': 'frp_max * 1.35'}.items())})
SELECT col AS "column", round(b, 6) AS before, round(a, 6) AS after,
  round(CASE WHEN abs(b) > 1e-9 THEN (a - b) / b * 100 ELSE 0 END, 6) AS delta_pct FROM long_form""")
def _(spark, sf):
    return rounded(X.summarize_shift(features(spark, sf), lambda df: X.run_scenario(df, "drought"), S.SHIFTED_WEATHER + S.FIRE[:2]), 6)
