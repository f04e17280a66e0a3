"""Metric gate, promotion decision and version table as column logic.

`runs` holds run_id, model, start_time and the metrics; `versions` holds name, version, stage
and run_id. All work per model, so many models are judged in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("None", "Staging", "Production", "Archived")


@dataclass(frozen=True)
class Thresholds:
    """Limits of the full gate."""
    rmse_max: float = 12.0
    mae_max: float = 8.0
    f1_macro_min: float = 0.78
    recall_bahaya_min: float | None = 0.85


# Limits for small synthetic data; recall is not checked there.
CI_THRESHOLDS = Thresholds(50.0, 30.0, 0.30, None)


# Wording of failed checks and of decisions.
CHECK_FAILED = "{metric}=%.{digits}f {sign} threshold {limit}"
NO_METRIC = "new model {metric} unavailable"
FIRST_VERSION = "no existing Production — first promotion"
COMPARED = "new %.4f {sign} threshold %.4f"
GAIN = " (improvement %.2f%% vs prod %.4f)"
NO_GAIN = " (no improvement {percent:.0f}%% vs prod %.4f)"


def evaluate_gate(runs: DataFrame, limits: Thresholds = Thresholds(), required: tuple[str, ...] | None = None) -> DataFrame:
    """`failed_checks` and `passed` per run.

    Every metric that has a limit must be there: a missing or NaN one fails the run. `required` names
    those that must, where runs hold a part of them; with `()` a missing metric passes.
    """
    if required is None:
        required = tuple(m for m, limit in (("rmse", limits.rmse_max), ("mae", limits.mae_max), ("f1_macro", limits.f1_macro_min),
                                            ("recall_bahaya", limits.recall_bahaya_min)) if limit is not None)
    def check(metric: str, limit: float | None, digits: int, above: bool) -> Column | None:
        if limit is None or metric not in runs.columns:
            return None
        value = F.col(metric)
        # Spark orders NaN above all numbers, so it has to be left out by hand.
        bad = ((value > limit) if above else (value < limit)) & ~F.isnan(value)
        sign = ">" if above else "<"
        return F.when(bad, F.format_string(CHECK_FAILED.format(metric=metric, digits=digits, sign=sign, limit=limit), value))
    checks = [c for c in (
        check("rmse", limits.rmse_max, 2, True), check("mae", limits.mae_max, 2, True),
        check("f1_macro", limits.f1_macro_min, 3, False),
        check("recall_bahaya", limits.recall_bahaya_min, 3, False)) if c is not None]
    for metric in required:
        value = F.col(metric) if metric in runs.columns else F.lit(None).cast("double")
        checks.append(F.when(value.isNull() | F.isnan(value), F.lit(f"{metric} is missing")))
    out = runs.withColumn("failed_checks", F.array_compact(F.array(*checks)))
    return out.withColumn("passed", F.size("failed_checks") == 0)


def newest_run(runs: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """The newest run per model, or over all runs for an empty `by`; ties go to the higher id."""
    rest = [c for c in runs.columns if c not in by]
    return (runs.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct("start_time", "run_id")).alias("_r"))
            .select(*by, "_r.*"))


def best_run(runs: DataFrame, metric: str = "rmse", lower_is_better: bool = True,
             by: tuple[str, ...] = ("model",)) -> DataFrame:
    """The run with the best metric; runs without it never win; ties go to the lower id."""
    rest = [c for c in runs.columns if c not in by]
    key = F.col(metric) if lower_is_better else -F.col(metric)
    usable = runs.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    return (usable.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(key, F.col("run_id"))).alias("_r"))
            .select(*by, "_r.*"))


def by_version(versions: DataFrame) -> DataFrame:
    return versions.orderBy("name", F.col("version").cast("int"))


def production_metric(versions: DataFrame, runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """Per model the run, version and metric now in Production."""
    current = (versions.filter(F.col("stage") == "Production").groupBy(F.col("name").alias("model"))
               .agg(F.max_by(F.struct("run_id", F.col("version").cast("int").alias("version")),
                             F.col("version").cast("int")).alias("_v"))
               .select("model", F.col("_v.run_id").alias("prod_run_id"), F.col("_v.version").alias("prod_version")))
    metrics = runs.select(F.col("run_id").alias("prod_run_id"), F.col(metric).alias("prod_metric"))
    return current.join(metrics, "prod_run_id", "left")


def compare_with_production(new_runs: DataFrame, versions: DataFrame, runs: DataFrame,
                            metric: str = "rmse") -> DataFrame:
    new = new_runs.select("model", F.col("run_id").alias("new_run_id"), F.col(metric).alias("new_metric"))
    return new.join(production_metric(versions, runs, metric), "model", "left")


def decide(compared: DataFrame, improvement: float = 0.02, lower_is_better: bool = True,
           metric: str = "rmse") -> DataFrame:
    """promote, keep-staging or abort, with the reason as text. The comparison is strict."""
    new, prod = F.col("new_metric"), F.col("prod_metric")
    bar = prod * F.lit(1 - improvement if lower_is_better else 1 + improvement)
    better = new < bar if lower_is_better else new > bar
    yes, no = ("<", ">=") if lower_is_better else (">", "<=")
    gain = F.format_string(GAIN, (prod - new) / prod * 100, prod)
    short = F.format_string(NO_GAIN.format(percent=improvement * 100), prod)
    decision = (F.when(new.isNull(), "abort").when(prod.isNull() | better, "promote").otherwise("keep-staging"))
    detail = (F.when(new.isNull(), F.lit(NO_METRIC.format(metric=metric)))
              .when(prod.isNull(), F.lit(FIRST_VERSION))
              .when(better, F.concat(F.format_string(COMPARED.format(sign=yes), new, bar),
                                     gain if lower_is_better else F.lit("")))
              .otherwise(F.concat(F.format_string(COMPARED.format(sign=no), new, bar),
                                  short if lower_is_better else F.lit(""))))
    return compared.withColumns({"decision": decision, "detail": detail})


def transition_stage(versions: DataFrame, name: str, version: int, stage: str,
                     archive_existing: bool = True) -> DataFrame:
    """One version to a new stage; others in a Staging or Production target are archived."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {sorted(STAGES)}, got {stage!r}")
    mine = F.col("name") == name
    chosen = mine & (F.col("version").cast("int") == version)
    after = F.when(chosen, F.lit(stage))
    if archive_existing and stage in ("Staging", "Production"):
        after = after.when(mine & (F.col("stage") == stage), F.lit("Archived"))
    return versions.withColumn("stage", after.otherwise(F.col("stage")))


def apply_decisions(versions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Register each decided run as its model's next version.

    Promotion archives the model's Production version; keep-staging archives nothing.
    """
    live = decisions.filter(F.col("decision").isin("promote", "keep-staging")).select(
        F.col("model").alias("name"), F.col("new_run_id").alias("run_id"), "decision")
    # One pass: each model's rows and its decision meet in one grouped join on the model name.
    judged = versions.join(live.select("name", (F.col("decision") == "promote").alias("_promoted")), "name", "left")
    kept = judged.withColumn("stage", F.when(F.col("_promoted") & (F.col("stage") == "Production"), F.lit("Archived"))
                             .otherwise(F.col("stage"))).drop("_promoted")
    last = versions.groupBy("name").agg(F.max(F.col("version").cast("int")).alias("_last"))
    added = live.join(last, "name", "left").select(
        "name", (F.coalesce("_last", F.lit(0)) + 1).cast(versions.schema["version"].dataType).alias("version"),
        F.when(F.col("decision") == "promote", "Production").otherwise("Staging").alias("stage"), "run_id")
    return kept.select("name", "version", "stage", "run_id").unionByName(added)


def audit_rows(decisions: DataFrame, triggered_at: Column, reason: Column) -> DataFrame:
    """Trace columns per run; the earlier metric appears only where there was one."""
    return decisions.select(
        "model", "new_run_id", triggered_at.alias("triggered_at"), reason.alias("reason"), "decision",
        F.when(F.col("prod_metric").isNotNull(), F.format_string("%.6f", "prod_metric")).alias("prev_prod_metric"))
