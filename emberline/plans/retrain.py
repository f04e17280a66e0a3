"""Gate, decision and report of a continuous-training round, per model."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.operators import gate as G


def gate_report(runs: DataFrame, limits: G.Thresholds = G.Thresholds(), required: tuple[str, ...] | None = None) -> DataFrame:
    judged = G.evaluate_gate(runs, limits, required)
    bounds = F.struct(*[F.lit(v).cast("double").alias(k) for k, v in asdict(limits).items()])
    metrics = F.struct("rmse", "mae", "f1_macro", "recall_bahaya")
    return judged.select("run_id", metrics.alias("metrics"), bounds.alias("thresholds"), "passed", "failed_checks")


def decide_round(runs: DataFrame, versions: DataFrame, improvement: float = 0.02) -> DataFrame:
    """Newest run of each model against its Production version."""
    return G.decide(G.compare_with_production(G.newest_run(runs), versions, runs), improvement)


def round_report(decisions: DataFrame, triggered_at: Column, reason: Column, elapsed: dict[str, Column] | None = None) -> DataFrame:
    """One nested report row per model, with a struct per stage; `elapsed` gives seconds by stage name where known."""
    taken = elapsed or {}

    def stage(name: str, ok: Column, detail: Column, label: Column | None = None) -> Column:
        seconds = taken.get(name, F.lit(None)).cast("double")
        return F.struct((F.lit(name) if label is None else label).alias("name"), ok.alias("ok"), detail.alias("detail"), seconds.alias("elapsed_s"))
    new, prod = F.col("new_metric"), F.col("prod_metric")
    stages = F.array(
        stage("evaluate_new", new.isNotNull(), F.when(new.isNull(), "no metric").otherwise(F.format_string("rmse=%.4f", new))),
        stage("get_production", F.lit(True),
              F.when(prod.isNull(), "no production version").otherwise(F.format_string("rmse=%.4f", prod))),
        stage("decide", F.col("decision") != "abort", F.col("detail")),
        # The last stage is named after what was done: promote, keep-staging or abort.
        stage("apply", F.col("decision") != "abort", F.concat(F.lit("run "), F.coalesce("new_run_id", F.lit("none"))), F.col("decision")))
    return decisions.select(
        "model", triggered_at.alias("triggered_at"), reason.alias("reason"), stages.alias("stages"),
        "new_run_id", "new_metric", "prod_run_id", "prod_metric", "decision")
