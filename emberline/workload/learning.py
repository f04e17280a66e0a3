"""Training and scoring queries. Their twins hold what is exact: rows, features, dates and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators import cleaning as C
from emberline.operators import gate as M
from emberline.operators import learning as N
from emberline.operators import metrics as R
from emberline.plans import features as P
from emberline.plans import scoring as G
from emberline.session import new_folder
from emberline.workload import standins as D
from emberline.workload.features import DAILY_SQL
from emberline.workload.registry import query


def table(spark, sf):
    weather = C.clean_weather(D.raw_weather(spark, sf, "group"), [F.desc("snapshot_id")])
    return P.training_table(D.detections(spark, sf, "group"), weather)


def all_classes(spark, sf):
    """Busy groups give classes 1 and 2, single users counted by calendar day 0 and 1."""
    users = P.training_table(D.detections(spark, sf, "user"), dense=True)
    return table(spark, sf).unionByName(users.withColumn(S.ENTITY, F.concat(F.lit("u"), S.ENTITY)), allowMissingColumns=True)


GROUPS_SQL = f"""{D.det_sql('group')}, {DAILY_SQL},
labelled AS (SELECT * FROM (SELECT province_id, date, hotspot_count, lead(hotspot_count) OVER (PARTITION BY province_id ORDER BY date) AS y FROM daily)
  WHERE y IS NOT NULL)"""


#: Model tables of this process, by application and folder of tables: what is trained once is loaded afterwards.
_REGISTERED: dict[tuple[str, str], tuple[str, str]] = {}
MODEL = "hotspot-regressor"


def saved(spark, out, name):
    """The rows as a table, so that what was cached for them can go."""
    folder = new_folder(spark, name)
    out.write.parquet(folder)
    return folder


def registered(spark, sf, anew=False):
    """Tables of models and versions with a regressor in Production, and the feature table it was trained on."""
    key = (spark.sparkContext.applicationId, sf)
    if anew or key not in _REGISTERED:
        data = saved(spark, table(spark, sf), "features")
        models = new_folder(spark, "models")
        N.save_model(N.train_regressor(N.time_split(spark.read.parquet(data))[0]), models, "run-1")
        _REGISTERED[key] = (data, models)
    data, models = (spark.read.parquet(x) for x in _REGISTERED[key])
    versions = spark.createDataFrame([(MODEL, 1, "Staging", "run-0"), (MODEL, 2, "Staging", "run-1")], "name string, version int, stage string, run_id string")
    return data, models, M.transition_stage(versions, MODEL, 2, "Production")


def error_of(df, forecast):
    return df.agg(F.avg(F.abs(F.col(S.TARGET_COUNT) - forecast)).alias("mae")).first()["mae"]


# Exact are rows, features and trees; the model is held against the median of the training side: on its own rows it has to be
# better, on held-out ones (here without a trend to learn) less than a fifth worse.
@query("train_regressor", f"""WITH {GROUPS_SQL}, side AS (SELECT *, date > (SELECT max(date) - 14 FROM labelled) AS held FROM labelled)
SELECT count(*) FILTER (held) AS n_rows, count(*) FILTER (NOT held) AS n_train_rows, CAST({len(S.FEATURES)} AS INTEGER) AS n_features,
  CAST({N.TrainParams().n_estimators} AS INTEGER) AS n_trees, true AS learns, true AS holds FROM side""")
def _(spark, sf):
    data, models, versions = registered(spark, sf, anew=True)
    model, (train, test) = N.staged_model(models, versions, MODEL), N.time_split(data)
    median = train.agg(F.percentile_approx(S.TARGET_COUNT, 0.5, 20_000)).first()[0]
    old, new = N.score(model, train), N.score(model, test)
    report = N.regressor_report(new, N.feature_names(data)).first()
    trees = model.nodes.agg(F.max("tree") + 1).first()[0]
    return spark.createDataFrame([(report["n_rows"], train.count(), report["n_features"], trees, error_of(old, F.col("prediction")) < error_of(train, F.lit(median)),
                                   report["mae"] < 1.2 * error_of(test, F.lit(median)))],
                                 "n_rows long, n_train_rows long, n_features int, n_trees int, learns boolean, holds boolean")


# Supports are exact; the balanced model has to have a higher macro F1 than the constant forecast of the most frequent class.
@query("train_classifier", f"""WITH {GROUPS_SQL}, {D.det_sql('user', 'udet')},
users AS (SELECT province_id, min(acq_date_wib) AS low, max(acq_date_wib) AS high FROM udet GROUP BY province_id),
days AS (SELECT province_id, CAST(unnest(generate_series(CAST(low AS TIMESTAMP), high - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM users WHERE high > low),
counted AS (SELECT d.date, count(u.province_id) AS y FROM days d LEFT JOIN udet u ON u.province_id = d.province_id AND u.acq_date_wib = d.date + 1 GROUP BY d.province_id, d.date),
every AS (SELECT date, y FROM labelled UNION ALL SELECT date, y FROM counted)
SELECT CAST(CASE WHEN y <= {S.AMAN_MAX} THEN 0 WHEN y <= {S.WASPADA_MAX} THEN 1 ELSE 2 END AS INTEGER) AS class, count(*) AS support, true AS known, true AS beats_constant
FROM every WHERE date > (SELECT max(date) - 14 FROM every) GROUP BY 1""")
def _(spark, sf):
    data = spark.read.parquet(saved(spark, all_classes(spark, sf), "features"))
    train, test = N.time_split(data)
    scored = spark.read.parquet(saved(spark, N.score(N.train_classifier(train), test).select(S.TARGET_CLASS, "prediction"), "scored"))
    report = R.class_report(R.confusion(scored, S.TARGET_CLASS, "prediction"))
    usual = train.groupBy(S.TARGET_CLASS).count().orderBy(F.desc("count")).first()[0]
    constant = N.classifier_report(test.select(S.TARGET_CLASS, F.lit(usual).alias("prediction"))).first()["f1_macro"]
    better = N.classifier_report(scored).first()["f1_macro"] > constant
    known = scored.where(~F.col("prediction").isin(list(S.RISK_LABELS)) | F.col("prediction").isNull()).isEmpty()
    return report.where("support > 0").select("class", "support", F.lit(known).alias("known"), F.lit(better).alias("beats_constant"))


# Loads the model in Production; predictions are exact only in that there is one for each area, with the class that its size asks for.
@query("score_latest", f"""WITH {GROUPS_SQL}
SELECT province_id, CAST(hotspot_count AS BIGINT) AS today_count, date AS date_today, true AS scored, true AS classed
FROM (SELECT *, row_number() OVER (PARTITION BY province_id ORDER BY date DESC) AS rn FROM labelled) WHERE rn = 1""")
def _(spark, sf):
    data, models, versions = registered(spark, sf)
    rows = G.score_latest(N.staged_model(models, versions, MODEL), data)
    level = F.when(F.col("prediction_count") <= S.AMAN_MAX, 0).when(F.col("prediction_count") <= S.WASPADA_MAX, 1).otherwise(2)
    return rows.select(S.ENTITY, F.col("today_count").cast("long").alias("today_count"), "date_today",
                       F.col("prediction_count").isNotNull().alias("scored"), (F.col("risk_level") == level).alias("classed"))


# A model outside Spark: here the mean of the last count and the three-day sum.
@query("score_foreign", f"""WITH {D.det_sql('group')}, {DAILY_SQL},
f AS (SELECT province_id, date, hotspot_count, sum(hotspot_count) OVER (PARTITION BY province_id ORDER BY date
  ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS s FROM daily)
SELECT province_id, date, (hotspot_count + coalesce(s, 0)) / CAST(2 AS DOUBLE) AS prediction FROM f""")
def _(spark, sf):
    data = P.daily_features(D.detections(spark, sf, "group"))
    names = ["hotspot_count", "hotspot_count_3d"]
    return N.score_foreign(data, lambda b: (b["hotspot_count"] + b["hotspot_count_3d"].fillna(0)) / 2, names).select(
        S.ENTITY, "date", "prediction")


@query("feature_projection", f"""WITH {D.det_sql('group')}, {DAILY_SQL}
SELECT hotspot_count, CAST(n_daytime AS BIGINT) AS n_daytime, n_nighttime, n_confidence_high, frp_max FROM daily""")
def _(spark, sf):
    from emberline.operators.daily import aggregate_daily
    daily = aggregate_daily(D.detections(spark, sf, "group")).drop("frp_mean", "frp_sum")
    return daily.select(*N.feature_names(daily))
