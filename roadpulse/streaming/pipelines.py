"""Replay and live pipelines: parse, build features, keep Silver, score, upsert, quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import clean
from ..functions.risk import context_risk
from ..operators.features import enrich_live, features_or_reason
from ..plans.jobs import score_replay
from ..schemas import LIVE_MESSAGE, LIVE_SCHEMA, RAW_COLUMNS, RAW_RENAMES, REPLAY_SCHEMA
from ..session import tuned
from ..sources.sinks import KeyedTable, write_silver
from ..sources.streams import parse_json

KEY = "event_id"
ORDER = ["processed_time", "ingestion_time"]
RAW_MESSAGE = ", ".join(f"`{c}` string" for c in [*RAW_COLUMNS, *RAW_RENAMES, "_ingested_at_utc"])


@dataclass
class StreamConfig:
    """Where a pipeline writes and how it is triggered.

    ``seconds`` is the trigger interval; without one the query drains what is there and stops.
    ``now`` fixes the processing time, which makes a run repeatable. ``spread`` redistributes each
    micro-batch over that many tasks before features are built: useful where a source brings few
    large files or has fewer partitions than the cluster has cores. After ``compact_after`` batches the
    serving table is compacted, so its reads and folders stay bounded. ``after_write`` is called with
    the number of a micro-batch when all its outputs are written and before it is committed; if it fails, the batch
    runs again.
    """

    checkpoint: str
    table: str
    silver: str | None = None
    quarantine: str | None = None
    seconds: int | None = None
    model: object | None = None
    fallback: float = -1.0
    now: str | None = None
    name: str | None = None
    spread: int | None = None
    compact_after: int = 64
    after_write: Callable[[int], None] | None = None

    def written(self, batch_id: int) -> None:
        if self.after_write is not None:
            self.after_write(batch_id)


def replay_messages(df: DataFrame, extra: str = "") -> DataFrame:
    """Message text to raw rows under plain names; ``extra`` adds fields to the message schema."""
    parsed = parse_json(df, f"{RAW_MESSAGE}, {extra}" if extra else RAW_MESSAGE)
    both = {plain: F.coalesce(F.col(plain), F.col(f"`{odd}`")) for odd, plain in RAW_RENAMES.items()}
    return parsed.withColumns(both).drop(*RAW_RENAMES)


def live_messages(df: DataFrame) -> DataFrame:
    """Message text to live incident rows."""
    return parse_json(df, LIVE_MESSAGE)


def _start(stream: DataFrame, config: StreamConfig, step) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", config.checkpoint)
    if config.name:
        writer = writer.queryName(config.name)
    writer = writer.trigger(availableNow=True) if config.seconds is None else writer.trigger(processingTime=f"{config.seconds} seconds")
    with tuned(stream.sparkSession):  # a query takes the settings it is started with
        return writer.start()


def _quarantine(bad: DataFrame, config: StreamConfig, batch_id: int) -> None:
    if config.quarantine:
        bad.write.mode("overwrite").parquet(f"{config.quarantine.rstrip('/')}/batch_id={batch_id}")


def replay_batch(batch: DataFrame, batch_id: int, config: StreamConfig) -> None:
    """One micro-batch of raw rows. Every output is a folder of this batch, replaced when it runs again.
    """
    keep = [c for c in ("predicted_severity", "inference_latency_ms") if c in batch.columns]
    stamp = F.col("_ingested_at_utc") if "_ingested_at_utc" in batch.columns else F.lit(None).cast("string")
    stamped = batch.withColumn("ingestion_time", clean.to_utc(stamp))
    stamped = stamped.repartition(config.spread) if config.spread else stamped
    rows = features_or_reason(stamped, [*keep, "ingestion_time"]).persist()
    try:
        _quarantine(rows.where("reject_reason is not null").select("reject_reason", "message"), config, batch_id)
        features = rows.where("reject_reason is null").drop("reject_reason", "message")
        if config.silver:
            write_silver(features, config.silver, batch_id)
        if "predicted_severity" in keep:
            features = features.withColumn("predicted_severity", F.col("predicted_severity").try_cast("int"))
        scored = score_replay(features, config.model, config.fallback, config.now)
        table = KeyedTable(batch.sparkSession, config.table, REPLAY_SCHEMA, KEY, ORDER)
        table.upsert(scored, batch_id, config.now)
        table.compact_beyond(config.compact_after)
    finally:
        rows.unpersist()
    config.written(batch_id)


def start_replay(stream: DataFrame, config: StreamConfig) -> StreamingQuery:
    """Starts the replay pipeline on a stream of raw rows."""
    return _start(stream, config, lambda df, i: replay_batch(df, i, config))


def live_rows(messages: DataFrame, weather: DataFrame | None, now=None) -> DataFrame:
    """Live messages to serving rows: enriched, featured, scored by rule."""
    return _served(_live_or_reason(messages, weather).where("reject_reason is null"), now)


def _live_or_reason(messages: DataFrame, weather: DataFrame | None) -> DataFrame:
    """One row per message: its features and what serving needs, or the reason and the message of a bad one."""
    names = set(messages.columns)
    text = lambda c: F.col(c) if c in names else F.lit(None).cast("string")
    arrived = F.coalesce(clean.to_utc(text("_ingested_at_utc").cast("string")), clean.to_utc(text("ingestion_time").cast("string")))
    carried = {
        "_incident_id": text("incident_id"), "_icon": clean.safe_int(text("icon_category")),
        "_magnitude": clean.safe_int(text("delay_magnitude")), "_delay": clean.safe_float(text("delay_seconds")),
        "_length": clean.safe_float(text("length_meters")), "_arrived": arrived,
    }
    passed = [c for c in ("state_or_region", "city", "from_road", "to_road", "geometry_wkt") if c in names]
    return features_or_reason(enrich_live(messages.withColumns(carried), weather, keep_bad=True), [*carried, *passed])


def _served(rows: DataFrame, now=None) -> DataFrame:
    """Good live rows as the serving table has them."""
    stamp = (F.lit(now) if now is not None else F.localtimestamp()).cast("timestamp_ntz")
    risk = context_risk(F.col("true_severity"), F.col("_delay"), F.col("_length"))
    return rows.withColumns(
        {
            "incident_id": F.col("_incident_id"), "severity": F.col("true_severity"), "risk_score": risk,
            "icon_category": F.col("_icon"), "delay_magnitude": F.col("_magnitude"), "delay_seconds": F.col("_delay"),
            "length_meters": F.col("_length"), "model_status": F.lit("rule_based"), "ingestion_time": F.col("_arrived"),
            "processed_time": stamp, "end_to_end_latency_ms": clean.latency_ms(F.col("_arrived"), stamp),
        }
    ).drop("_incident_id", "_icon", "_magnitude", "_delay", "_length", "_arrived", "reject_reason", "message")


def live_batch(batch: DataFrame, batch_id: int, config: StreamConfig, weather: DataFrame | None) -> None:
    """One micro-batch of live messages: every message is served or quarantined, from one parse."""
    spread = batch.repartition(config.spread) if config.spread else batch
    rows = _live_or_reason(spread, weather).persist()
    try:
        _quarantine(rows.where("reject_reason is not null").select("reject_reason", "message"), config, batch_id)
        table = KeyedTable(batch.sparkSession, config.table, LIVE_SCHEMA, KEY, ORDER)
        table.upsert(_served(rows.where("reject_reason is null"), config.now), batch_id, config.now)
        table.compact_beyond(config.compact_after)
    finally:
        rows.unpersist()
    config.written(batch_id)


def start_live(stream: DataFrame, config: StreamConfig, weather: DataFrame | None = None) -> StreamingQuery:
    """Starts the live pipeline. The weather table is read anew for each batch, so fresh slots are seen."""
    return _start(stream, config, lambda df, i: live_batch(df, i, config, weather))
