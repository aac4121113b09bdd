"""Parsing and cleaning of hostile text columns, as JVM expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WEATHER_BOUNDS

# Characters dropped from both ends of a text value (the usual white space, control separators, NBSP).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Accepted number and time spellings.
NUMBER_PATTERN = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|nan|inf|infinity)$"
)
PLAIN_NUMBER_PATTERN = r"^[0-9.+\-eE]+$"
TIME_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2}|\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?"
    r"|\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2})([+-]\d{2}:?\d{2})?$"
)
PLAIN_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$"
OFFSET_PATTERN = r":\d{1,2}(?:\.\d+)?([+-]\d{2}):?(\d{2})$"
TRUE_WORDS = ("true", "1", "yes", "y")

# Text fragments and the code each one gives, tested in this order.
WEATHER_RULES = [
    (4, ("thunder", "storm")),
    (2, ("snow", "ice", "sleet")),
    (1, ("rain", "drizzle", "shower")),
    (3, ("fog", "haze", "mist")),
    (5, ("cloud", "overcast")),
    (6, ("wind",)),
]
ROAD_RULES = [
    (1, ("interstate", "i-", "freeway", "fwy", "highway", "hwy")),
    (2, ("route", "us-", "sr-")),
    (3, ("street", " st", "st.")),
    (4, ("avenue", " ave", "ave.")),
    (5, ("boulevard", " blvd", "blvd.")),
    (6, ("drive", " dr", "dr.")),
    (7, ("road", " rd", "rd.")),
]
# Numeric weather codes of the hourly feed and their labels.
WEATHER_LABELS = {
    "Thunderstorm": (95, 96, 99),
    "Snow": (71, 73, 75, 77, 85, 86),
    "Rain": (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82),
    "Fog": (45, 48),
    "Cloudy": (1, 2, 3),
}


def stripped(c: Column) -> Column:
    """Text without surrounding white space."""
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def safe_string(c: Column, default: str | None = "") -> Column:
    """Stripped text; blank or null gives the default."""
    return F.coalesce(F.nullif(stripped(c), F.lit("")), F.lit(default))


def safe_float(c: Column, default: float | None = None) -> Column:
    """Text to double, or the default. Accepts exactly the spellings of NUMBER_PATTERN.

    Text made of digits, signs, dots and exponents goes straight to the cast; only other text needs
    the full pattern.
    """
    text = stripped(c)
    number = F.when(text.rlike(PLAIN_NUMBER_PATTERN), text.try_cast("double")).when(
        text.rlike(NUMBER_PATTERN), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    )
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def safe_int(c: Column, default: int | None = None) -> Column:
    """Text to int through double, cutting the fraction; NaN and overflow give the default."""
    number = safe_float(c).try_cast("int")
    return number if default is None else F.coalesce(number, F.lit(int(default)))


def clip(number: Column, lower: float, upper: float) -> Column:
    """Number held inside [lower, upper]. NaN ends at upper."""
    return F.greatest(F.lit(float(lower)), F.least(F.lit(float(upper)), number))


def clip_float(c: Column, default: float, lower: float, upper: float) -> Column:
    """Text to double, default when bad, then held inside [lower, upper]."""
    return clip(safe_float(c, default), lower, upper)


def weather_number(feature: str, c: Column) -> Column:
    """One weather number under its contract bounds."""
    _, default, lower, upper = WEATHER_BOUNDS[feature]
    return clip_float(c, default, lower, upper)


def bool_int(c: Column) -> Column:
    """1 for the words of TRUE_WORDS in any case, else 0."""
    return F.coalesce(F.lower(stripped(c)).isin(*TRUE_WORDS), F.lit(False)).cast("int")


def _time_text(c: Column) -> Column:
    return F.replace(stripped(c), F.lit("Z"), F.lit(""))


def parse_event_time(c: Column) -> Column:
    """Wall-clock timestamp (no zone) or null. An offset in the text is accepted and ignored."""
    text = _time_text(c)
    without_offset = F.regexp_replace(text, r"[+-]\d{2}:?\d{2}$", "")
    wall = F.when(text.rlike(OFFSET_PATTERN), without_offset).otherwise(text)
    return F.when(text.rlike(PLAIN_TIME_PATTERN), text.try_cast("timestamp_ntz")).when(
        text.rlike(TIME_PATTERN), wall.try_cast("timestamp_ntz")
    )


def to_utc(c: Column) -> Column:
    """Timestamp without zone, shifted to UTC when the text carries an offset."""
    text = _time_text(c)
    hours = F.regexp_extract(text, OFFSET_PATTERN, 1)
    minutes = F.regexp_extract(text, OFFSET_PATTERN, 2)
    sign = F.when(hours.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    shift = F.coalesce(hours.try_cast("int") * 60 + sign * minutes.try_cast("int"), F.lit(0))
    shifted = parse_event_time(c) - F.make_dt_interval(mins=shift)
    return F.when(text.rlike(PLAIN_TIME_PATTERN), text.try_cast("timestamp_ntz")).otherwise(shifted)


def norm_ts(c: Column) -> Column:
    """Optional ISO timestamp, null when blank or bad."""
    return parse_event_time(c)


def hour_floor(t: Column) -> Column:
    """Start of the hour, without zone."""
    return F.date_trunc("hour", t).cast("timestamp_ntz")


def utc_hour(c: Column) -> Column:
    """Text timestamp in UTC, floored to the hour."""
    return hour_floor(to_utc(c))


def iso_text(t: Column) -> Column:
    """ISO text of a timestamp; a fraction is written only when there is one."""
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    has_fraction = F.date_format(t, "SSSSSS") != "000000"
    return F.when(has_fraction, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(whole)


def is_weekend(day_of_week: Column) -> Column:
    """1 on Sunday (1) and Saturday (7)."""
    return day_of_week.isin(1, 7).cast("int")


def is_rush_hour(hour: Column) -> Column:
    """1 from 7 to 9 and from 16 to 18, ends included."""
    return (hour.between(7, 9) | hour.between(16, 18)).cast("int")


def is_night(c: Column) -> Column:
    """1 when the daylight text says night."""
    return (F.lower(safe_string(c)) == "night").cast("int")


def infer_light(c: Column) -> Column:
    """Night from 22:00 to 05:59 by the wall clock of the text, else Day."""
    return light_at(parse_event_time(c))


def light_at(t: Column) -> Column:
    """Night from 22:00 to 05:59, else Day; Day without a time."""
    return F.when(F.pmod(F.hour(t) + 2, F.lit(24)) < 8, F.lit("Night")).otherwise(F.lit("Day"))


def rule_text(c: Column) -> Column:
    """Text as the rules below read it. Compute it once, in a projection of its own."""
    return F.lower(stripped(c))


def first_rule(text: Column, rules: list[tuple[int, tuple[str, ...]]]) -> Column:
    """Code of the first rule with a fragment in the text, else 0."""
    out = None
    for code, fragments in rules:
        hit = reduce(lambda a, b: a | b, [text.contains(f) for f in fragments])
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return out.otherwise(F.lit(0))


def weather_code(c: Column) -> Column:
    """Weather text to code 0..6, first matching rule."""
    return first_rule(rule_text(c), WEATHER_RULES)


def road_type_code(c: Column) -> Column:
    """Street text to road type 0..7, first matching rule."""
    return first_rule(rule_text(c), ROAD_RULES)


def weather_label(code: Column) -> Column:
    """Numeric weather code of the hourly feed, possibly text, to its label."""
    return weather_label_of(safe_int(code))


def weather_label_of(code: Column) -> Column:
    """Integer weather code to its label; unknown or null gives Clear."""
    out = None
    for label, codes in WEATHER_LABELS.items():
        hit = code.isin(*codes)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit("Clear"))


def first_non_empty(*columns: Column, default: str = "") -> Column:
    """First stripped text that is not blank."""
    return F.coalesce(*[F.nullif(stripped(c), F.lit("")) for c in columns], F.lit(default))


def join_array(c: Column, separator: str = ", ") -> Column:
    """Array of text as one text; null gives blank."""
    return F.array_join(F.coalesce(c, F.array().cast("array<string>")), separator)


def latency_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two timestamps, null when either is missing."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros.cast("double") / 1000


def parse_window(text: str | None) -> int:
    """Seconds of a duration such as ``5m``; 300 when it cannot be read, 1 at least."""
    text = (text or "5m").strip()
    number, unit = text[:-1].strip(), text[-1:]
    scale = {"s": 1, "m": 60, "h": 3600, "d": 86400}
    if not number.isascii() or not number.isdigit() or unit not in scale:
        return 300
    return max(1, int(number) * scale[unit])
