"""Raw rows to the 24-column feature contract, with row-level quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..functions.risk import live_severity
from ..schemas import (
    FEATURE_COLUMNS,
    FEATURE_SCHEMA,
    FILL_DEFAULTS,
    FLAG_SOURCES,
    MODEL_FEATURES,
    RAW_COLUMNS,
    REQUIRED_COLUMNS,
    WEATHER_BOUNDS,
)
from .weather import join_weather


def _raw(df: DataFrame, name: str) -> Column:
    """A raw column, or null text where the file lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _is_text(df: DataFrame, name: str) -> bool:
    return name not in df.columns or isinstance(df.schema[name].dataType, T.StringType)


def _number(df: DataFrame, name: str) -> Column:
    """A raw number; columns that are numbers already need no parsing."""
    return clean.safe_float(_raw(df, name)) if _is_text(df, name) else F.col(name).cast("double")


def _integer(df: DataFrame, name: str) -> Column:
    return clean.safe_int(_raw(df, name)) if _is_text(df, name) else F.col(name).try_cast("int")


def _time(df: DataFrame, name: str) -> Column:
    return clean.parse_event_time(_raw(df, name)) if _is_text(df, name) else F.col(name).cast("timestamp_ntz")


def _flag(df: DataFrame, name: str) -> Column:
    if _is_text(df, name):
        return clean.bool_int(_raw(df, name))
    return F.coalesce(F.col(name).cast("int") == 1, F.lit(False)).cast("int")


def _parsed(df: DataFrame) -> DataFrame:
    """Raw row plus its parsed critical fields and rule texts, each computed once."""
    return df.select(
        "*",
        F.nullif(clean.safe_string(_raw(df, "ID")), F.lit("")).alias("_id"),
        _time(df, "Start_Time").alias("_time"),
        _number(df, "Start_Lat").alias("_lat"),
        _number(df, "Start_Lng").alias("_lon"),
        _integer(df, "Severity").alias("_severity"),
        clean.rule_text(_raw(df, "Weather_Condition")).alias("_weather"),
        clean.rule_text(_raw(df, "Street")).alias("_street"),
    )


_PARSED = ("_id", "_time", "_lat", "_lon", "_severity", "_weather", "_street")


def _reject_reason() -> Column:
    """First failed rule of a parsed row, or null. NaN lies outside every range."""
    return (
        F.when(F.col("_time").isNull(), F.lit("bad_time"))
        .when(F.col("_lat").isNull() | F.col("_lon").isNull(), F.lit("bad_coordinate"))
        .when(F.col("_severity").isNull(), F.lit("bad_severity"))
        .when(F.col("_id").isNull(), F.lit("missing_id"))
        .when(
            ~(F.col("_lat").between(-90.0, 90.0) & F.col("_lon").between(-180.0, 180.0)),
            F.lit("coordinate_out_of_range"),
        )
        .when(~F.col("_severity").between(1, 4), F.lit("severity_out_of_range"))
    )


def _features(parsed: DataFrame, keep: list[str]) -> DataFrame:
    hour = F.hour("_time")
    day = F.dayofweek("_time")
    columns = {
        "event_id": F.col("_id"),
        "event_year": F.year("_time"),
        "event_time": F.col("_time"),
        "true_severity": F.col("_severity"),
        "lat": F.col("_lat"),
        "lon": F.col("_lon"),
        "hour": hour,
        "day_of_week": day,
        "is_weekend": clean.is_weekend(day),
        "is_rush_hour": clean.is_rush_hour(hour),
        "weather_code": clean.first_rule(F.col("_weather"), clean.WEATHER_RULES),
        "road_type_code": clean.first_rule(F.col("_street"), clean.ROAD_RULES),
        "is_night": clean.is_night(_raw(parsed, "Sunrise_Sunset")),
    }
    for feature, (source, default, low, high) in WEATHER_BOUNDS.items():
        columns[feature] = clean.clip(F.coalesce(_number(parsed, source), F.lit(default)), low, high)
    for feature, source in FLAG_SOURCES.items():
        columns[feature] = _flag(parsed, source)
    return parsed.select(*[columns[c].alias(c) for c in FEATURE_COLUMNS], *keep)


def _acceptable() -> Column:
    """Rows without a reject reason. Names each parsed field once: the optimizer moves this filter
    below the parsing, where every mention parses the text again."""
    return (
        F.col("_time").isNotNull()
        & (F.abs("_lat") <= 90.0)
        & (F.abs("_lon") <= 180.0)
        & F.col("_severity").isin(1, 2, 3, 4)
        & F.col("_id").isNotNull()
    )


def build_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Feature contract of every acceptable raw row; ``keep`` names raw columns to carry along."""
    return _features(_parsed(df).where(_acceptable()), keep or [])


def features_or_reason(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per raw row: the features of a good one, or the reason and the raw row as JSON of a bad one.

    Cached, it serves both outputs of a micro-batch from one parse, and it is narrow: the raw text of
    good rows is not carried.
    """
    parsed = _parsed(df).withColumn("reject_reason", _reject_reason())
    message = F.when(F.col("reject_reason").isNotNull(), F.to_json(F.struct(*df.columns)))
    return _features(parsed.withColumn("message", message), [*(keep or []), "reject_reason", "message"])


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Raw rows with the reason they cannot become features; null for good rows."""
    return _parsed(df).withColumn("reject_reason", _reject_reason()).drop(*_PARSED)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows that will become features, and the others with their reason."""
    rows = with_reject_reason(df)
    good = rows.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, rows.where(F.col("reject_reason").isNotNull())


def scan_report(df: DataFrame) -> DataFrame:
    """Rows read, rows that become features, rows dropped."""
    reason = F.col("reject_reason")
    return with_reject_reason(df).agg(
        F.count("*").alias("rows_read"),
        F.count_if(reason.isNull()).alias("valid_rows"),
        F.count_if(reason.isNotNull()).alias("dropped_rows"),
    )


def to_contract(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Feature rows as they are written to files: ISO time text, weather as floats."""
    time = clean.iso_text(F.col("event_time")) if dict(df.dtypes)["event_time"] != "string" else F.col("event_time")
    ready = df.withColumn("event_time", time)
    return ready.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_SCHEMA], *(keep or []))


def enrich_live(df: DataFrame, weather: DataFrame | None = None, keep_bad: bool = False) -> DataFrame:
    """Live incident messages as raw rows with typed values, ready for ``build_features``.

    Rows without position, time or id are left out, or kept for a reject reason with ``keep_bad``. Weather comes from the hourly table; where it has
    no row for the cell and day, the weather is Clear, 50 F, 50 %, 0 mph.
    """
    has = set(df.columns)
    null = F.lit(None).cast("string")
    texts = lambda *names: [F.col(n) for n in names if n in has] or [null]
    first = lambda *names: next((n for n in names if n in has), names[0])
    flag = lambda name: _integer(df, name) if name in has else F.lit(0)
    time = clean.first_non_empty(*texts("timestamp", "event_timestamp", "last_report_time"))
    events = df.select(
        "*",
        _number(df, first("latitude", "lat")).alias("_live_lat"),
        _number(df, first("longitude", "lon", "lng")).alias("_live_lon"),
        time.alias("_live_time"),
        clean.first_non_empty(*texts("event_id", "incident_id")).alias("_live_id"),
    )
    if not keep_bad:
        events = events.where("_live_lat is not null and _live_lon is not null and _live_time <> '' and _live_id <> ''")
    events = events.withColumns(
        {"_live_wall": clean.parse_event_time(F.col("_live_time")), "_live_utc": clean.to_utc(F.col("_live_time"))}
    )
    if weather is not None:
        events = join_weather(events, weather, "_live_lat", "_live_lon", "_live_utc")
        label = F.when(F.col("wx_slot").isNotNull(), clean.weather_label_of(F.col("wx_weather_code")))
        numbers = {c: F.col(f"wx_{c}").cast("double") for c in ("temperature_f", "humidity", "wind_speed_mph")}
    else:
        label, numbers = null, {}
    none = F.lit(None).cast("double")
    roads = clean.join_array(F.col("road_numbers")) if "road_numbers" in has else F.lit("")
    raw = {
        "ID": F.col("_live_id"),
        "Severity": live_severity(_integer(df, "delay_magnitude"), _integer(df, "icon_category")),
        "Start_Time": F.col("_live_wall"),
        "Start_Lat": F.col("_live_lat"),
        "Start_Lng": F.col("_live_lon"),
        "Weather_Condition": F.coalesce(label, F.lit("Clear")),
        "Temperature_F": F.coalesce(numbers.get("temperature_f", none), F.lit(50.0)),
        "Humidity_pct": F.coalesce(numbers.get("humidity", none), F.lit(50.0)),
        "Wind_Speed_mph": F.coalesce(numbers.get("wind_speed_mph", none), F.lit(0.0)),
        "Visibility_mi": F.coalesce(_number(df, "visibility_mi"), F.lit(10.0)),
        "Street": F.coalesce(*[F.nullif(clean.stripped(c), F.lit("")) for c in texts("from_road", "to_road")], roads),
        **{source: flag(feature) for feature, source in FLAG_SOURCES.items()},
        "Sunrise_Sunset": clean.light_at(F.col("_live_wall")),
    }
    taken = {n.lower() for n in raw}
    kept = [c for c in df.columns if c.lower() not in taken]
    return events.select(*kept, *[c.alias(n) for n, c in raw.items()])


def enrich_stream(df: DataFrame, weather: DataFrame | None = None, live_source: str = "live") -> DataFrame:
    """Rows of a mixed topic as raw text rows: live ones enriched, the others passed on as they are."""
    source = F.lower(clean.safe_string(F.col("source")))
    live = enrich_live(df.where(source == live_source), weather)
    live = live.select(*[F.col(c).cast("string").alias(c) if c in RAW_COLUMNS else F.col(c) for c in live.columns])
    return df.where(source != live_source).unionByName(live, allowMissingColumns=True)


def stream_features(
    df: DataFrame, weather: DataFrame | None = None, keep: list[str] | None = None, live_source: str = "live"
) -> DataFrame:
    """Features of a mixed topic. Each kind of row keeps its own types, so live values that are numbers
    already are not written as text and parsed again."""
    source = F.lower(clean.safe_string(F.col("source")))
    live = build_features(enrich_live(df.where(source == live_source), weather), keep)
    return build_features(df.where(source != live_source), keep).unionByName(live)


def drop_required(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows whose required columns are all present."""
    return df.dropna(subset=columns or REQUIRED_COLUMNS)


def valid_range(df: DataFrame) -> DataFrame:
    """Rows with severity 1..4 and coordinates on the globe."""
    return df.where(
        F.col("true_severity").between(1, 4) & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    """Null optional features to the Gold defaults (0, not the defaults of the feature builder)."""
    return df.fillna({c: v for c, v in FILL_DEFAULTS.items() if c in df.columns})


def complete_features(df: DataFrame) -> DataFrame:
    """Rows that have every model feature."""
    return df.dropna(subset=MODEL_FEATURES)
