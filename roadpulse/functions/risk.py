"""Severity and risk expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score of each severity, and the bonus or malus of each circumstance.
BASE_SCORE = {1: 0.00, 2: 0.25, 3: 0.55, 4: 0.85}
DELAY_PER_MINUTE, DELAY_LIMIT = 0.01, 0.10
LENGTH_PER_100_M, LENGTH_LIMIT = 0.005, 0.08
NIGHT, WEEKEND, HIGHWAY, BAD_WEATHER, QUIET_ROAD = 0.03, 0.02, 0.03, 0.03, 0.02
HIGHWAY_CODE = 1
QUIET_ROAD_CODES = (3, 4, 6)
BAD_WEATHER_CODES = (1, 2, 4)
HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
LAST_RESORT_RISK = 0.25
# Floors given by an incident's icon category.
ICON_FLOORS = {8: 4, 1: 3, 9: 2}
# Weights of the fallback severity estimate and its class limits.
HEURISTIC_START = 0.18
HEURISTIC_FLAGS = [
    ("is_rush_hour", 0.20), ("is_night", 0.12), ("is_junction", 0.10),
    ("is_crossing", 0.08), ("has_traffic_signal", 0.08),
]
HEURISTIC_WEATHER, HEURISTIC_WEATHER_CODES = 0.10, (1, 2, 3, 4, 6)
HEURISTIC_VISIBILITY, HEURISTIC_WIND = 0.18, 0.10
HEURISTIC_LIMITS = ((0.75, 4), (0.50, 3), (0.25, 2))


def _zero(c: Column | None) -> Column:
    return F.lit(0) if c is None else F.coalesce(c, F.lit(0))


def _bonus(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))


def _capped(amount: Column | None, unit: float, rate: float, limit: float) -> Column:
    if amount is None:
        return F.lit(0.0)
    value = amount.cast("double")
    return F.when(value > 0, F.least(value / unit * rate, F.lit(limit))).otherwise(F.lit(0.0))


def _base(severity: Column) -> Column:
    out = F.when(severity == 1, F.lit(BASE_SCORE[1]))
    for level in (2, 3, 4):
        out = out.when(severity == level, F.lit(BASE_SCORE[level]))
    return out.otherwise(F.lit(0.0))


def _unit(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def _adjustments(severity, delay, length, night, weekend, road, weather) -> list[Column]:
    """Terms in summation order; the malus comes last and is negative."""
    quiet = _zero(road).isin(*QUIET_ROAD_CODES) & (_zero(severity) <= 2)
    return [
        _capped(delay, 60.0, DELAY_PER_MINUTE, DELAY_LIMIT),
        _capped(length, 100.0, LENGTH_PER_100_M, LENGTH_LIMIT),
        _bonus(_zero(night) == 1, NIGHT),
        _bonus(_zero(weekend) == 1, WEEKEND),
        _bonus(_zero(road) == HIGHWAY_CODE, HIGHWAY),
        _bonus(_zero(weather).isin(*BAD_WEATHER_CODES), BAD_WEATHER),
        _bonus(quiet, -QUIET_ROAD),
    ]


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def clamp_severity(c: Column) -> Column:
    """Severity held inside 1..4; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(4), c.cast("int"))))


def risk_score(
    severity: Column,
    delay_seconds: Column | None = None,
    length_meters: Column | None = None,
    is_night: Column | None = None,
    is_weekend: Column | None = None,
    road_type_code: Column | None = None,
    weather_code: Column | None = None,
) -> Column:
    """Risk on the write path: severity is clamped and the result rounded to four places.

    The circumstances are summed first and added to the base score, so that the last digit matches
    the scores already stored.
    """
    level = clamp_severity(severity)
    extra = _sum(
        _adjustments(
            level, delay_seconds, length_meters, is_night, is_weekend, road_type_code, weather_code
        )
    )
    return F.when(level.isNotNull(), F.round(_unit(_base(level) + extra), 4))


def context_risk(severity: Column, delay: Column | None = None, length: Column | None = None) -> Column:
    """Write-path risk of a row that has the contract's context columns."""
    return risk_score(
        severity, delay, length,
        F.col("is_night"), F.col("is_weekend"), F.col("road_type_code"), F.col("weather_code"),
    )


def effective_risk(
    stored: Column,
    severity: Column,
    delay_seconds: Column | None = None,
    length_meters: Column | None = None,
) -> Column:
    """Risk on the read path: a stored score inside 0..1, else the unrounded formula, else null."""
    terms = _adjustments(
        severity, delay_seconds, length_meters,
        F.col("is_night"), F.col("is_weekend"), F.col("road_type_code"), F.col("weather_code"),
    )
    formula = _unit(_sum([_base(severity), *terms]))
    return F.when(stored.between(0.0, 1.0), stored.cast("double")).when(severity.between(1, 4), formula)


def effective_risk_replay() -> Column:
    """Read-path risk of a replay serving row."""
    return effective_risk(F.col("risk_score"), F.coalesce(F.col("predicted_severity"), F.col("true_severity")))


def effective_risk_live() -> Column:
    """Read-path risk of a live serving row."""
    return effective_risk(
        F.col("risk_score"), F.col("severity"), F.col("delay_seconds"), F.col("length_meters")
    )


def live_severity(delay_magnitude: Column, icon_category: Column) -> Column:
    """Severity of a live incident from its delay magnitude, raised by its icon category."""
    by_delay = (
        F.when(delay_magnitude >= 4, F.lit(4)).when(delay_magnitude.isin(2, 3), delay_magnitude)
        .otherwise(F.lit(1))
    )
    by_icon = F.lit(1)
    for icon, floor in ICON_FLOORS.items():
        by_icon = F.when(icon_category == icon, F.lit(floor)).otherwise(by_icon)
    return F.greatest(by_delay, by_icon).cast("int")


def risk_level(score: Column) -> Column:
    """Label of a score; null counts as 0."""
    value = F.coalesce(score, F.lit(0.0))
    return (
        F.when(value >= HIGH_RISK, F.lit("high")).when(value >= MEDIUM_RISK, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def infer_severity(
    predicted_severity: Column,
    prediction: Column,
    predict: Column,
    severity: Column,
    probabilities: list[Column],
) -> Column:
    """Severity of a prediction payload.

    The first label that is neither null nor 0 wins; if all are, the last one counts as it is. With
    no label at all the most probable class is taken, the lowest on a tie.
    """
    zero = F.lit(0)
    label = F.coalesce(
        F.nullif(predicted_severity, zero), F.nullif(prediction, zero), F.nullif(predict, zero), severity
    )
    ranked = F.array_compact(
        F.array(
            *[
                F.when(p.isNotNull() & ~F.isnan(p), F.struct(p.cast("double").alias("p"), F.lit(-k).alias("k")))
                for k, p in enumerate(probabilities, start=1)
            ]
        )
    )
    return F.coalesce(clamp_severity(label.try_cast("int")), -F.array_max(ranked)["k"])


def score_with_fallback(fallback: float = -1.0) -> tuple[Column, Column]:
    """Risk and model status of a scored replay row.

    Risk comes from the predicted severity, else the true one, else the configured constant when it
    is not negative, else 0.25.
    """
    last = round(max(0.0, min(1.0, fallback)), 4) if fallback >= 0 else LAST_RESORT_RISK
    risk = F.coalesce(
        context_risk(F.col("predicted_severity")), context_risk(F.col("true_severity")), F.lit(last)
    )
    status = F.when(F.col("predicted_severity").isNotNull(), F.lit("ok")).otherwise(F.lit("failed"))
    return risk, status


def heuristic_severity() -> Column:
    """Severity estimate from context alone, for vectors no model has scored."""
    terms = [F.lit(HEURISTIC_START)]
    terms += [_bonus(F.col(c) == 1, weight) for c, weight in HEURISTIC_FLAGS]
    terms.append(_bonus(F.col("weather_code").isin(*HEURISTIC_WEATHER_CODES), HEURISTIC_WEATHER))
    lack = F.greatest(F.lit(0.0), (F.lit(10.0) - F.col("visibility_mi")) / 10.0)
    terms.append(lack * HEURISTIC_VISIBILITY)
    wind = F.least(F.greatest(F.col("wind_speed_mph"), F.lit(0.0)), F.lit(100.0))
    terms.append(wind / 100.0 * HEURISTIC_WIND)
    score = _unit(_sum(terms))
    out = None
    for limit, level in HEURISTIC_LIMITS:
        out = F.when(score >= limit, F.lit(level)) if out is None else out.when(score >= limit, F.lit(level))
    return out.otherwise(F.lit(1))


def heat_weight(score: Column) -> Column:
    """Weight of a point in a heat map."""
    return F.greatest(F.lit(0.05), score)
