"""Metric, gate and promotion queries.

Runs and model versions come from `part`: the part key is the run, the size is the model.
Predictions are the persistence forecast against the next day's count.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.functions.hashing import uniform
from emberline.functions.risk import risk_level
from emberline.operators import daily as A
from emberline.operators import gate as G
from emberline.operators import learning as N
from emberline.operators import metrics as M
from emberline.operators import targets as T
from emberline.workload import standins as D
from emberline.workload.features import DAILY_SQL, RISK_SQL, rounded
from emberline.workload.registry import query


def scored(spark, sf):
    labelled = T.drop_unlabelled(T.add_targets(A.aggregate_daily(D.detections(spark, sf, "group"))))
    return labelled.withColumn("prediction", F.col("hotspot_count").cast("double")).withColumn(
        "predicted_level", risk_level(F.col("prediction")))


SCORED_SQL = f"""{DAILY_SQL},
ahead AS (SELECT *, lead(hotspot_count) OVER (PARTITION BY province_id ORDER BY date) AS y FROM daily),
scored AS (SELECT province_id, date, CAST(y AS DOUBLE) AS y, CAST(hotspot_count AS DOUBLE) AS p,
  {RISK_SQL.format(c='y', none='NULL')} AS yl, {RISK_SQL.format(c='hotspot_count', none='NULL')} AS pl
  FROM ahead WHERE y IS NOT NULL)"""

REPORT_SQL = """classes AS (SELECT yl AS class FROM scored UNION SELECT pl FROM scored),
report AS (SELECT class, count(*) FILTER (yl = class AND pl = class) AS tp, count(*) FILTER (yl = class) AS actual,
  count(*) FILTER (pl = class) AS predicted FROM classes, scored GROUP BY class),
rated AS (SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
  CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS recall,
  CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted) ELSE 0 END AS f1, actual AS support FROM report)"""


@query("regression_metrics", f"""WITH {D.det_sql('group')}, {SCORED_SQL}
SELECT province_id, round(sqrt(avg((y - p) ** 2)), 8) AS rmse, round(avg(abs(y - p)), 8) AS mae, count(*) AS n_rows
FROM scored GROUP BY province_id""")
def _(spark, sf):
    return rounded(M.regression_metrics(scored(spark, sf), S.TARGET_COUNT, "prediction", ["province_id"]))


@query("class_report", f"""WITH {D.det_sql('group')}, {SCORED_SQL}, {REPORT_SQL}
SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM rated""")
def _(spark, sf):
    return rounded(M.class_report(M.confusion(scored(spark, sf), S.TARGET_CLASS, "predicted_level")))


@query("classification_metrics", f"""WITH {D.det_sql('group')}, {SCORED_SQL}, {REPORT_SQL}
SELECT round(avg(f1), 8) AS f1_macro, round(coalesce(max(recall) FILTER (class = 2), 0), 8) AS recall_bahaya,
  CAST(sum(support) AS BIGINT) AS n_rows FROM rated""")
def _(spark, sf):
    return rounded(M.classification_metrics(
        M.class_report(M.confusion(scored(spark, sf), S.TARGET_CLASS, "predicted_level"))))


@query("class_distribution", f"""WITH {D.det_sql('group')}, {SCORED_SQL}
SELECT CAST(yl AS INTEGER) AS risk_level, count(*) AS n FROM scored GROUP BY yl""")
def _(spark, sf):
    return M.class_distribution(scored(spark, sf), S.TARGET_CLASS)


@query("class_weights", f"""WITH {D.det_sql('group')}, {SCORED_SQL}, c AS (SELECT yl, count(*) AS n FROM scored GROUP BY yl)
SELECT s.province_id, s.date, CAST(s.yl AS INTEGER) AS risk_level,
  round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * c.n), 8) AS weight FROM scored s JOIN c USING (yl)""")
def _(spark, sf):
    return rounded(M.with_class_weights(scored(spark, sf), S.TARGET_CLASS).select(
        "province_id", "date", S.TARGET_CLASS, "weight"))


@query("time_split", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT province_id, date, date > (SELECT max(date) FROM daily) - 14 AS is_test FROM daily""")
def _(spark, sf):
    daily = A.aggregate_daily(D.detections(spark, sf, "user"))
    return N.add_split(daily).select("province_id", "date", "is_test")


# Fewer dates than the holdout: one row in five, by keyed hash, is the test side.
@query("hash_split", f"""WITH {D.det_sql('user')}, {DAILY_SQL}
SELECT province_id, date,
  CAST(('0x' || substring(md5(concat_ws('|', province_id, CAST(date AS VARCHAR), '42')), 1, 8)) AS UBIGINT)
    / CAST(4294967296 AS DOUBLE) < 0.2 AS is_test FROM daily""")
def _(spark, sf):
    daily = A.aggregate_daily(D.detections(spark, sf, "user"))
    return N.add_split(daily, holdout_days=60).select("province_id", "date", "is_test")


@query("hash_uniform", """SELECT event_id,
  CAST(('0x' || substring(md5(concat_ws('|', CAST(event_id AS VARCHAR), '7')), 1, 8)) AS UBIGINT) / CAST(4294967296 AS DOUBLE) AS u
FROM events""")
def _(spark, sf):
    return D.table(spark, sf, "events").select("event_id", uniform(7, F.col("event_id")).alias("u"))


def runs(spark, sf):
    k = F.col("p_partkey")
    return D.table(spark, sf, "part").select(
        F.concat(F.lit("r"), F.lpad(k.cast("string"), 9, "0")).alias("run_id"),
        F.concat(F.lit("m"), F.col("p_size").cast("string")).alias("model"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((k % 97).cast("int"))).alias("start_time"),
        F.when(k % 13 != 0, (k * 7 % 311) / F.lit(20.0)).alias("rmse"), ((k * 11 % 211) / F.lit(20.0)).alias("mae"),
        F.when(k % 5 == 0, F.lit(float("nan"))).otherwise((k * 17 % 101) / F.lit(100.0)).alias("f1_macro"),
        F.when(k % 3 != 0, (k * 19 % 103) / F.lit(100.0)).alias("recall_bahaya"))


RUN_SQL = """runs AS (
  SELECT 'r' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS run_id, 'm' || p_size AS model, p_partkey,
    TIMESTAMP '2024-01-01' + (INTERVAL 1 DAY) * CAST(p_partkey % 97 AS INTEGER) AS start_time,
    CASE WHEN p_partkey % 13 <> 0 THEN (p_partkey * 7 % 311) / CAST(20 AS DOUBLE) END AS rmse,
    (p_partkey * 11 % 211) / CAST(20 AS DOUBLE) AS mae,
    CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey * 17 % 101) / CAST(100 AS DOUBLE) END AS f1_macro,
    CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey * 19 % 103) / CAST(100 AS DOUBLE) END AS recall_bahaya
  FROM part),
newest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1)"""


def versions(spark, sf):
    k = F.col("p_partkey")
    return D.table(spark, sf, "part").select(
        F.concat(F.lit("m"), F.col("p_size").cast("string")).alias("name"), k.cast("string").alias("version"),
        F.when(F.col("p_size") % 6 == 0, "None").otherwise(
            F.element_at(F.array(*[F.lit(s) for s in G.STAGES]), (k % 4 + 1).cast("int"))).alias("stage"),
        F.concat(F.lit("r"), F.lpad(k.cast("string"), 9, "0")).alias("run_id"))


VERSION_SQL = """versions AS (
  SELECT 'm' || p_size AS name, CAST(p_partkey AS VARCHAR) AS version,
    CASE WHEN p_size % 6 = 0 THEN 'None'
      ELSE list_extract(['None', 'Staging', 'Production', 'Archived'], CAST(p_partkey % 4 + 1 AS INTEGER)) END AS stage,
    'r' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS run_id FROM part)"""
PROD_SQL = """prod AS (SELECT v.name AS model, v.run_id AS prod_run_id, CAST(v.version AS INTEGER) AS prod_version, r.rmse AS prod_metric
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CAST(version AS INTEGER) DESC) AS rn FROM versions WHERE stage = 'Production') v
  LEFT JOIN runs r ON r.run_id = v.run_id WHERE v.rn = 1),
compared AS (SELECT n.model, n.run_id AS new_run_id, n.rmse AS new_metric, p.prod_run_id, p.prod_version, p.prod_metric
  FROM newest n LEFT JOIN prod p ON p.model = n.model)"""
DECIDED_SQL = """decided AS (SELECT *, CASE WHEN new_metric IS NULL THEN 'abort' WHEN prod_metric IS NULL THEN 'promote'
  WHEN new_metric < prod_metric * CAST(0.98 AS DOUBLE) THEN 'promote' ELSE 'keep-staging' END AS decision FROM compared)"""
ALL_SQL = f"{RUN_SQL}, {VERSION_SQL}, {PROD_SQL}, {DECIDED_SQL}"


def compared(spark, sf):
    table = runs(spark, sf)
    return G.compare_with_production(G.newest_run(table), versions(spark, sf), table)


def gate_sql(rmse, mae, f1, recall) -> str:
    checks = [f"CASE WHEN rmse > {rmse} THEN printf('rmse=%.2f > threshold {rmse}', rmse) END",
              f"CASE WHEN mae > {mae} THEN printf('mae=%.2f > threshold {mae}', mae) END",
              f"CASE WHEN f1_macro < {f1} THEN printf('f1_macro=%.3f < threshold {f1}', f1_macro) END"]
    if recall:
        checks.append(f"CASE WHEN recall_bahaya < {recall} THEN printf('recall_bahaya=%.3f < threshold {recall}', recall_bahaya) END")
    return f"""WITH {RUN_SQL}, checked AS (SELECT run_id, concat_ws('; ', {', '.join(checks)}) AS failed_checks FROM runs)
SELECT run_id, failed_checks, failed_checks = '' AS passed FROM checked"""


def gate_rows(df):
    return df.select("run_id", F.array_join("failed_checks", "; ").alias("failed_checks"), "passed")


@query("metric_gate", gate_sql(12.0, 8.0, 0.78, 0.85))
def _(spark, sf):
    return gate_rows(G.evaluate_gate(runs(spark, sf), required=()))


@query("metric_gate_ci", gate_sql(50.0, 30.0, 0.3, None))
def _(spark, sf):
    return gate_rows(G.evaluate_gate(runs(spark, sf), G.CI_THRESHOLDS, required=()))


@query("metric_gate_required", f"""WITH {RUN_SQL}
SELECT run_id, coalesce(rmse <= 12.0, false) AND mae <= 8.0 AND coalesce(f1_macro >= 0.78, false) AND coalesce(recall_bahaya >= 0.85, false) AS passed
FROM runs""")
def _(spark, sf):
    required = ("rmse", "mae", "f1_macro", "recall_bahaya")
    return G.evaluate_gate(runs(spark, sf), required=required).select("run_id", "passed")


@query("newest_run", f"WITH {RUN_SQL} SELECT model, run_id, start_time, rmse FROM newest")
def _(spark, sf):
    return G.newest_run(runs(spark, sf)).select(
        "model", "run_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "rmse")


# One row: the newest run of all.
@query("newest_run_overall", f"WITH {RUN_SQL} SELECT run_id, model FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 1")
def _(spark, sf):
    return G.newest_run(runs(spark, sf), ()).select("run_id", "model")


@query("best_run", f"""WITH {RUN_SQL}
SELECT model, run_id, rmse FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY rmse, run_id) AS rn FROM runs WHERE rmse IS NOT NULL) WHERE rn = 1""")
def _(spark, sf):
    return G.best_run(runs(spark, sf)).select("model", "run_id", "rmse")


@query("best_run_higher", f"""WITH {RUN_SQL}
SELECT model, run_id, f1_macro FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1_macro DESC, run_id) AS rn FROM runs WHERE f1_macro IS NOT NULL) WHERE rn = 1""")
def _(spark, sf):
    return G.best_run(runs(spark, sf), "f1_macro", False).select("model", "run_id", "f1_macro")


@query("versions_in_order", f"""WITH {VERSION_SQL}
SELECT name, version, row_number() OVER (PARTITION BY name ORDER BY CAST(version AS INTEGER)) AS position FROM versions""")
def _(spark, sf):
    from pyspark.sql import Window
    w = Window.partitionBy("name").orderBy(F.col("version").cast("int"))
    return G.by_version(versions(spark, sf)).select("name", "version", F.row_number().over(w).cast("long").alias("position"))


@query("compare_with_production", f"WITH {ALL_SQL} SELECT * FROM compared")
def _(spark, sf):
    return compared(spark, sf)


@query("promotion_decision", f"""WITH {ALL_SQL}
SELECT model, decision, CASE WHEN new_metric IS NULL THEN 'new model rmse unavailable'
  WHEN prod_metric IS NULL THEN 'no existing Production — first promotion'
  WHEN decision = 'promote' THEN printf('new %.4f < threshold %.4f (improvement %.2f%% vs prod %.4f)', new_metric,
    prod_metric * CAST(0.98 AS DOUBLE), (prod_metric - new_metric) / prod_metric * 100, prod_metric)
  ELSE printf('new %.4f >= threshold %.4f (no improvement 2%% vs prod %.4f)', new_metric, prod_metric * CAST(0.98 AS DOUBLE), prod_metric) END AS detail
FROM decided""")
def _(spark, sf):
    return G.decide(compared(spark, sf)).select("model", "decision", "detail")


@query("stage_transition", f"""WITH {VERSION_SQL}
SELECT name, version, CASE WHEN name = 'm1' AND version = (SELECT max(CAST(p_partkey AS INTEGER)) FROM part WHERE p_size = 1)::VARCHAR THEN 'Production'
  WHEN name = 'm1' AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage FROM versions""")
def _(spark, sf):
    table = versions(spark, sf)
    newest = table.filter(F.col("name") == "m1").agg(F.max(F.col("version").cast("int"))).first()[0]
    return G.transition_stage(table, "m1", newest, "Production").select("name", "version", "stage")


@query("apply_decisions", f"""WITH {ALL_SQL},
kept AS (SELECT v.name, v.version, CASE WHEN d.decision = 'promote' AND v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage, v.run_id
  FROM versions v LEFT JOIN decided d ON d.model = v.name)
SELECT * FROM kept UNION ALL
SELECT model, CAST(coalesce((SELECT max(CAST(version AS INTEGER)) FROM versions v WHERE v.name = d.model), 0) + 1 AS VARCHAR),
  CASE WHEN decision = 'promote' THEN 'Production' ELSE 'Staging' END, new_run_id FROM decided d WHERE decision <> 'abort'""")
def _(spark, sf):
    return G.apply_decisions(versions(spark, sf), G.decide(compared(spark, sf)))


@query("audit_rows", f"""WITH {ALL_SQL}
SELECT model, new_run_id, '2024-06-01T00:00:00' AS triggered_at, 'manual' AS reason, decision,
  CASE WHEN prod_metric IS NOT NULL THEN printf('%.6f', prod_metric) END AS prev_prod_metric FROM decided""")
def _(spark, sf):
    return G.audit_rows(G.decide(compared(spark, sf)), F.lit("2024-06-01T00:00:00"), F.lit("manual"))
