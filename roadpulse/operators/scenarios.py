"""What-if vectors: rules, scoring, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import context_risk, heuristic_severity, risk_level
from ..schemas import MODEL_FEATURES

# Column -> allowed range, ends included.
SCENARIO_RANGES = {
    "hour": (0, 23), "day_of_week": (1, 7),
    **{
        c: (0, 1)
        for c in (
            "is_weekend", "is_rush_hour", "is_junction", "has_traffic_signal", "is_crossing",
            "is_roundabout", "is_stop", "is_station", "is_railway", "is_night",
        )
    },
}


def check_scenario(df: DataFrame) -> DataFrame:
    """Vectors with the names of the fields that are missing or out of range."""
    broken = [
        F.when(~F.coalesce(F.col(c).between(low, high), F.lit(False)), F.lit(c))
        for c, (low, high) in SCENARIO_RANGES.items()
    ]
    others = [F.when(F.col(c).isNull(), F.lit(c)) for c in MODEL_FEATURES if c not in SCENARIO_RANGES]
    return df.withColumn("violations", F.array_compact(F.array(*broken, *others)))


def _scored(df: DataFrame, severity, status) -> DataFrame:
    out = df.withColumns({"predicted_severity": severity, "model_status": status})
    out = out.withColumn("risk_score", F.coalesce(context_risk(F.col("predicted_severity")), F.lit(0.0)))
    return out.withColumn("risk_level", risk_level(F.col("risk_score")))


def predict_scenarios(df: DataFrame, model=None) -> DataFrame:
    """Vectors with severity, risk, label and status; without a model the estimate from context serves."""
    if model is None:
        return _scored(df, heuristic_severity(), F.lit("heuristic_fallback"))
    from .ml import score

    scored = score(df.drop("predicted_severity"), model)
    return _scored(scored, F.coalesce(F.col("predicted_severity"), F.lit(2)), F.lit("ok"))


def preset_severity(df: DataFrame, presets: DataFrame) -> DataFrame:
    """Vectors that equal a preset in every feature, scored with the preset's severity.

    ``presets`` has preset_name, preset_severity and the model features.
    """
    named = presets.select("preset_name", "preset_severity", *MODEL_FEATURES)
    matched = df.join(named, MODEL_FEATURES)
    return _scored(matched, F.col("preset_severity"), F.lit("preset_rule_based")).drop("preset_severity")


def compare_scenarios(baseline: DataFrame, scenario: DataFrame, key: str) -> DataFrame:
    """Change of risk and severity from baseline to scenario, by key.

    The percentage comes from the unrounded change and is 0 where the baseline's risk is 0.
    """
    columns = ["predicted_severity", "risk_score"]
    left = baseline.select(key, *[F.col(c).alias(f"baseline_{c}") for c in columns])
    right = scenario.select(key, *[F.col(c).alias(f"scenario_{c}") for c in columns])
    change = F.col("scenario_risk_score") - F.col("baseline_risk_score")
    percent = F.when(F.col("baseline_risk_score") != 0, change / F.col("baseline_risk_score") * 100)
    return left.join(right, key).select(
        "*",
        F.round(change, 4).alias("risk_score_change"),
        F.round(F.coalesce(percent, F.lit(0.0)), 2).alias("risk_percent_change"),
        (F.col("scenario_predicted_severity") - F.col("baseline_predicted_severity")).alias("severity_change"),
    )
