"""Feature drift and retrain conditions named in the configuration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S
from emberline.operators.ranks import nearest_ranks

# Fixed values from the configuration.
DRIFT_FEATURES = ["hotspot_count", "frp_mean", "precipitation_sum", "relative_humidity_2m_mean", "days_since_rain"]
PSI_LIMIT = 0.2
RMSE_INCREASE_PCT = 20
EVENT_HOTSPOTS_PER_DAY = 500
DRY_DAYS, WET_DAYS = 90, 60
DRY_FIRST_MONTH, DRY_LAST_MONTH = 4, 10
MIN_SAMPLES = 500

BINS = 10
SMALLEST_SHARE = 1e-4


def stability_index(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Population stability index per feature against the baseline's exact deciles.

    An empty bin counts as a share of 1e-4, so the logarithm exists.
    """
    def long_form(df: DataFrame) -> DataFrame:
        doubles = df.select(*[F.col(c).cast("double").alias(c) for c in features])
        return doubles.unpivot([], features, "feature", "v").filter(F.col("v").isNotNull())
    base = long_form(baseline)
    cuts = nearest_ranks(base, "v", [i / BINS for i in range(1, BINS)], by=["feature"])
    edges = cuts.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("edges"))
    both = base.withColumn("now", F.lit(False)).unionByName(long_form(current).withColumn("now", F.lit(True)))
    # `edges` has one row per feature name, nine numbers each: its size does not depend on the data.
    binned = both.join(F.broadcast(edges), "feature").withColumn(
        "bin", F.size(F.filter("edges", lambda e: e < F.col("v"))))

    def count(i: int, now: bool):
        side = F.col("now") if now else ~F.col("now")
        return F.count_if(side & (F.col("bin") == i))
    counts = binned.groupBy("feature").agg(
        *[count(i, False).alias(f"e{i}") for i in range(BINS)], *[count(i, True).alias(f"a{i}") for i in range(BINS)])

    def share(side: str, i: int):
        total = sum((F.col(f"{side}{j}") for j in range(BINS)), F.lit(0))
        return F.greatest(F.when(total > 0, F.col(f"{side}{i}") / total), F.lit(SMALLEST_SHARE))
    psi = sum(((share("a", i) - share("e", i)) * F.ln(share("a", i) / share("e", i)) for i in range(BINS)), F.lit(0.0))
    return counts.select("feature", psi.alias("psi")).withColumn("drifted", F.col("psi") > PSI_LIMIT)


def training_window(features: DataFrame, today: date) -> DataFrame:
    """The last 90 days in the dry season, the last 60 in the wet one."""
    days = DRY_DAYS if DRY_FIRST_MONTH <= today.month <= DRY_LAST_MONTH else WET_DAYS
    return features.filter((F.col("date") > F.date_sub(F.lit(today), days)) & (F.col("date") <= F.lit(today)))


def event_days(daily: DataFrame, limit: int | Column = EVENT_HOTSPOTS_PER_DAY) -> DataFrame:
    """Days with enough hotspots, over all entities, to trigger a retrain."""
    return (daily.groupBy("date").agg(F.sum("hotspot_count").alias("n_hotspots"))
            .filter(F.col("n_hotspots") >= limit))


def rmse_trigger(old: DataFrame, new: DataFrame, by: str = S.ENTITY) -> DataFrame:
    """Whether RMSE rose by the configured share, and whether there are rows enough to retrain."""
    joined = old.select(by, F.col("rmse").alias("old_rmse")).join(
        new.select(by, F.col("rmse").alias("new_rmse"), "n_rows"), by)
    return joined.withColumns({
        "rmse_rose": F.col("new_rmse") > F.col("old_rmse") * (1 + RMSE_INCREASE_PCT / 100),
        "enough_rows": F.col("n_rows") >= MIN_SAMPLES})
