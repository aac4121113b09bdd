"""Running pipelines: starting again after failures, several streams side by side, and their rates."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Progress reports kept for each stream.
KEPT = 10_000
RATES = "stream string, batch_id long, input_rows long, batch_seconds double, rows_per_second double"


def run_until_drained(start: Callable[[], StreamingQuery], restarts: int = 3, delay_seconds: float = 0.0) -> int:
    """Runs a draining pipeline to its end and returns how often it had to be started again.

    ``start`` starts the query on its checkpoint. A failed micro-batch runs again from there with the same
    rows; its outputs are folders of the batch, so what it had written is replaced and not doubled. The
    failure after the last restart is raised.
    """
    for attempt in range(restarts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == restarts:
                raise
            time.sleep(delay_seconds)
    return restarts


class Rates(StreamingQueryListener):
    """Progress of the named streams of a session: one row per finished micro-batch that had input."""

    def __init__(self, names: list[str], kept: int = KEPT) -> None:
        self.rows = {n: deque(maxlen=kept) for n in names}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name in self.rows and p.numInputRows:
            seconds = p.durationMs.get("triggerExecution", 0) / 1000
            self.rows[p.name].append((p.name, p.batchId, p.numInputRows, seconds, p.numInputRows / seconds if seconds else None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def have(self, query: StreamingQuery) -> bool:
        """Whether the last micro-batch of a query that had input has been reported."""
        last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=None)
        return last is None or any(row[1] == last for row in list(self.rows[query.name]))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([row for rows in self.rows.values() for row in rows], RATES)


def run_together(spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]], wait_seconds: float = 30.0) -> DataFrame:
    """Runs several draining streams at the same time and returns their rates, one row per stream and micro-batch.

    Each stream's jobs go to a scheduler pool of its name, so that under fair scheduling (``build_session`` asks
    for it) a stream with large batches does not hold up the others. The queries must be named as the
    starters are. If one fails, the others are stopped and its failure is raised.
    """
    rates, context, queries = Rates(list(starters)), spark.sparkContext, []
    spark.streams.addListener(rates)
    try:
        for name, start in starters.items():
            context.setLocalProperty("spark.scheduler.pool", name)
            queries.append(start())
        context.setLocalProperty("spark.scheduler.pool", None)
        for query in queries:
            query.awaitTermination()
        until = time.monotonic() + wait_seconds  # reports arrive a little later than the end
        while time.monotonic() < until and not all(map(rates.have, queries)):
            time.sleep(0.05)
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
        for query in queries:
            query.stop()
        spark.streams.removeListener(rates)
    return rates.table(spark)
