"""Serving queries over the replay and live tables under one projection."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.risk import effective_risk_live, effective_risk_replay, risk_level

MODES = ("replay", "live", "full")


@dataclass(frozen=True)
class Sources:
    """The serving tables; a missing one is None. Labels name each source in results."""

    replay: DataFrame | None = None
    live: DataFrame | None = None
    replay_label: str = "replay"
    live_label: str = "live"


def create_views(sources: Sources, gold: DataFrame | None = None) -> list[str]:
    """Temporary views ``replay``, ``live`` and ``gold`` for SQL access, as far as the tables are there; returns their names."""
    found = {"replay": sources.replay, "live": sources.live, "gold": gold}
    for name, df in found.items():
        if df is not None:
            df.createOrReplaceTempView(name)
    return [name for name, df in found.items() if df is not None]


def normalize_mode(mode: str | None) -> str:
    """replay, live or full; anything else means full."""
    return mode if mode in MODES else "full"


def mode_sources(sources: Sources, mode: str | None) -> dict[str, DataFrame]:
    """Tables that a mode reads, by kind, leaving out missing ones."""
    mode = normalize_mode(mode)
    found = {"replay": sources.replay, "live": sources.live}
    return {kind: df for kind, df in found.items() if df is not None and mode in (kind, "full")}


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def project(df: DataFrame, kind: str, label: str) -> DataFrame:
    """Common projection of one serving table. Live severity serves as predicted and as true."""
    replay = kind == "replay"
    risk = effective_risk_replay() if replay else effective_risk_live()
    predicted = F.col("predicted_severity") if replay else F.col("severity")
    actual = F.col("true_severity") if replay else F.col("severity")
    return df.select(
        "event_id", "lat", "lon", risk.alias("risk_score"),
        predicted.alias("predicted_severity"), actual.alias("true_severity"), "event_time",
        "model_status", _optional(df, "created_at", "timestamp_ntz").alias("created_at"),
        F.lit(label).alias("data_source"), F.lit("circle" if replay else "triangle").alias("marker_shape"),
        "hour", "temperature_f", "humidity", "wind_speed_mph",
        F.coalesce((actual >= 3) | (predicted >= 3), F.lit(False)).alias("is_severe"),
    )


def projected(sources: Sources, mode: str | None) -> list[DataFrame]:
    """The common projection of each table that a mode reads."""
    labels = {"replay": sources.replay_label, "live": sources.live_label}
    return [project(df, kind, labels[kind]) for kind, df in mode_sources(sources, mode).items()]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def common_view(sources: Sources, mode: str | None = "full") -> DataFrame:
    """Union of the tables that a mode reads, under the common projection."""
    frames = projected(sources, mode)
    if not frames:
        raise ValueError("no serving table is available for this mode")
    return union_all(frames)


def time_range(df: DataFrame, start=None, end=None, column: str = "event_time") -> DataFrame:
    """Rows inside an inclusive range; an open bound does not filter. Bounds reach the file scan."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("timestamp_ntz"))
    return df


def default_bounds(df: DataFrame, seconds: int, column: str = "event_time") -> DataFrame:
    """Rows of the last ``seconds`` before the table's latest time.

    The latest time is a scalar subquery: it runs first and its value joins the scan's filters.
    """
    latest = df.select(F.max(column)).scalar()
    return df.where(
        (F.col(column) >= latest - F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")))
        & (F.col(column) <= latest)
    )


def min_risk(df: DataFrame, value: float) -> DataFrame:
    """Rows at or above a risk; rows without risk drop out."""
    return df.where(F.col("risk_score") >= value)


def parse_bbox(bbox: str) -> tuple[float, float, float, float]:
    """Bounds of ``min_lon,min_lat,max_lon,max_lat``."""
    parts = [float(p) for p in bbox.split(",")]
    if len(parts) != 4:
        raise ValueError("bbox must be min_lon,min_lat,max_lon,max_lat")
    return parts[0], parts[1], parts[2], parts[3]


def in_bbox(df: DataFrame, bbox: str) -> DataFrame:
    """Rows inside a box, edges included."""
    min_lon, min_lat, max_lon, max_lat = parse_bbox(bbox)
    return df.where(F.col("lon").between(min_lon, max_lon) & F.col("lat").between(min_lat, max_lat))


POINT_COLUMNS = [
    "event_id", "lat", "lon", "risk_score", "predicted_severity", "true_severity", "event_time",
    "model_status", "data_source", "marker_shape",
]


def _newest(df: DataFrame, n: int) -> DataFrame:
    """The n latest rows. Spark keeps at most n per task, so nothing larger is ever gathered."""
    return df.orderBy(F.col("event_time").desc_nulls_last(), F.col("event_id")).limit(n)


def _balanced_newest(frames: list[DataFrame], mode: str, limit: int) -> DataFrame:
    """Latest rows; in full mode each source gives its share, so that none crowds out the other."""
    if mode == "full" and len(frames) > 1:
        share = max(1, math.ceil(limit / len(frames)))
        frames = [_newest(f, share) for f in frames]
    return _newest(union_all(frames), limit)


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "risk_level": risk_level(F.col("risk_score")),
            "model_status": F.coalesce(F.nullif(F.col("model_status"), F.lit("")), F.lit("unknown")),
        }
    )


def map_points(
    sources: Sources,
    bbox: str | None = None,
    min_risk_score: float = 0.0,
    start=None,
    end=None,
    limit: int = 5000,
    mode: str | None = None,
) -> DataFrame:
    """Points for a map: filtered, balanced over the sources, latest first."""
    frames = []
    for df in projected(sources, mode):
        df = time_range(df.select(*POINT_COLUMNS), start, end)
        df = in_bbox(df, bbox) if bbox else df
        frames.append(min_risk(df, min_risk_score))
    return _labelled(_balanced_newest(frames, normalize_mode(mode), limit))


def latest_predictions(sources: Sources, limit: int = 100, mode: str | None = None) -> DataFrame:
    """The most recent rows, balanced over the sources."""
    frames = [df.select(*POINT_COLUMNS) for df in projected(sources, mode)]
    return _labelled(_balanced_newest(frames, normalize_mode(mode), limit))


def event_detail(sources: Sources, event_id: str) -> DataFrame:
    """One event by id; the replay table is asked first. The id filter reaches both scans."""
    columns = [*POINT_COLUMNS, "created_at"]
    hits = [
        df.where(F.col("event_id") == event_id).select(*columns, F.lit(rank).alias("_rank"))
        for rank, df in enumerate(projected(sources, "full"))
    ]
    return _labelled(union_all(hits).orderBy("_rank", F.col("event_time").desc_nulls_last()).limit(1).drop("_rank"))
