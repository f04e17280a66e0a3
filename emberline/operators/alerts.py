"""Alert payloads to retrain triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schemas as S

SUMMARY_CHARS = 80


def parse_alert(payload: Column) -> dict[str, Column]:
    """Name and reason of the first firing alert in a JSON payload."""
    alerts = F.from_json(payload, S.ALERT_PAYLOAD)["alerts"]
    first = F.get(F.filter(alerts, lambda a: a["status"] == "firing"), F.lit(0))
    name = F.coalesce(first["labels"]["alertname"], F.lit("unknown"))
    summary = F.coalesce(first["annotations"]["summary"], F.lit(""))
    tail = F.when(summary != "", F.concat(F.lit(" | "), F.substring(summary, 1, SUMMARY_CHARS))).otherwise("")
    return {
        "alert": F.when(first.isNotNull(), name).otherwise("unknown"),
        "reason": F.when(first.isNotNull(), F.concat(F.lit("grafana_alert:"), name, tail))
                   .otherwise("no firing alerts in payload"),
    }


def trigger_rows(log: DataFrame, payload: str = "payload") -> DataFrame:
    parsed = parse_alert(F.col(payload))
    return log.select("ts", parsed["alert"].alias("alert"), parsed["reason"].alias("reason"),
                      F.lit("spawned").alias("action"))


def recent_triggers(triggers: DataFrame, n: int = 50, tie_break: tuple[str, ...] = ()) -> DataFrame:
    return triggers.orderBy(F.desc("ts"), *[F.desc(c) for c in tie_break]).limit(n)
