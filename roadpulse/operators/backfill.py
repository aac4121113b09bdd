"""Filling predictions that are missing from the replay serving table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import context_risk
from .keyed import update_from

FILLED = ["predicted_severity", "risk_score", "model_status"]


def backfill_candidates(table: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows without a good prediction that have not failed before; oldest first when limited."""
    status = F.coalesce(F.col("model_status"), F.lit(""))
    missing = (
        F.col("predicted_severity").isNull() | (status != "ok") | F.col("risk_score").isNull()
        | (F.col("risk_score") < 0)
    )
    rows = table.where(missing & (status != "backfill_failed"))
    if limit is None:
        return rows
    return rows.orderBy(F.col("created_at").asc_nulls_last(), "event_id").limit(limit)


def backfill_updates(candidates: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """New values of the candidates. ``scorer`` sets predicted_severity, null where it fails.

    A failed row is scored by its true severity and marked, so that it is not tried again.
    """
    scored = scorer(candidates.drop("predicted_severity"))
    predicted = F.nullif(F.col("predicted_severity"), F.lit(0))
    severity = F.coalesce(predicted, F.col("true_severity"))
    status = F.when(F.col("predicted_severity").isNotNull(), F.lit("ok")).otherwise(F.lit("backfill_failed"))
    return scored.select("event_id", "predicted_severity", context_risk(severity).alias("risk_score"), status.alias("model_status"))


def backfill(table: DataFrame, scorer: Callable[[DataFrame], DataFrame], limit: int | None = None) -> DataFrame:
    """The table with its missing predictions filled, in one plan. Running it again changes nothing more."""
    return update_from(table, backfill_updates(backfill_candidates(table, limit), scorer), "event_id", FILLED)
