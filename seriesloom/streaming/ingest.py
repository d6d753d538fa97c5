"""Streaming ingest: JSON messages to date-partitioned tables, exactly once per checkpoint."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.files import with_date_parts
from ..sources.messages import decode_json, read_stream

DATE_PARTS = ("year", "month", "day")


@dataclass(frozen=True)
class Topic:
    """One message topic: where it comes from, what its messages hold, where they go."""

    schema: T.StructType
    folder: str
    source: Mapping[str, object]  # arguments of read_stream
    ts: str = "dt"
    value_col: str = "value"


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append to a parquet table. ``trigger`` is ``available`` (all there is, then stop), an interval
    such as ``10 seconds``, or None for back-to-back micro-batches."""
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def bronze(messages: DataFrame, topic: Topic) -> DataFrame:
    """Messages decoded to flat columns with the date parts of their event time."""
    return with_date_parts(decode_json(messages, topic.schema, topic.value_col), topic.ts)


def start_ingest(
    spark: SparkSession,
    topics: Mapping[str, Topic],
    base: str,
    trigger: str | None = None,
    partitioned: bool = True,
) -> dict[str, StreamingQuery]:
    """One query per topic, each with its own schema, folder and checkpoint."""
    return {
        name: write_stream(
            bronze(read_stream(spark, **topic.source), topic),
            f"{base}/{topic.folder}",
            f"{base}/checkpoints/{topic.folder}",
            trigger,
            DATE_PARTS if partitioned else (),
        )
        for name, topic in topics.items()
    }


class Progress(StreamingQueryListener):
    """Totals of streaming queries, added up from every micro-batch; ``recentProgress`` forgets all but the last
    hundred. Counts only numbers a query (by run id), whatever the run's length.

    Events come in on another thread and a moment late: ``wait`` returns when the end of a run has come in, and
    by then all its batches have.
    """

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._runs: dict[str, dict] = {}

    def _of(self, run_id: object) -> dict:
        start = {"batch_id": None, "last_rows": 0, "total_rows": 0, "batches": 0, "active": True, "error": None}
        return self._runs.setdefault(str(run_id), start)

    def onQueryStarted(self, event: object) -> None:
        with self._changed:
            self._of(event.runId)

    def onQueryProgress(self, event: object) -> None:
        p = event.progress
        with self._changed:
            run = self._of(p.runId)
            run |= {"batch_id": p.batchId, "last_rows": p.numInputRows, "batches": run["batches"] + 1}
            run["total_rows"] += p.numInputRows

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        with self._changed:
            self._of(event.runId).update(active=False, error=event.exception)
            self._changed.notify_all()

    def of(self, query: StreamingQuery) -> dict:
        """Last micro-batch, its rows, rows and batches so far, whether the run goes on, and its error if any."""
        with self._changed:
            return dict(self._of(query.runId))

    def wait(self, query: StreamingQuery, timeout_s: float = 60.0) -> dict:
        """``of`` once the query has ended and its last event has come in."""
        query.awaitTermination()
        with self._changed:
            self._changed.wait_for(lambda: not self._of(query.runId)["active"], timeout_s)
            return dict(self._of(query.runId))


def ingest_available(
    spark: SparkSession, topics: Mapping[str, Topic], base: str, partitioned: bool = True
) -> dict[str, dict]:
    """Ingest everything the topics hold and return; a later call continues from the checkpoints."""
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        queries = start_ingest(spark, topics, base, "available", partitioned)
        return {name: seen.wait(q) for name, q in queries.items()}
    finally:
        spark.streams.removeListener(seen)


def progress(query: StreamingQuery) -> dict:
    """Last micro-batch and the rows of the micro-batches that Spark still remembers; ``Progress`` counts all."""
    recent = query.recentProgress
    return {
        "batch_id": recent[-1]["batchId"] if recent else None,
        "last_rows": recent[-1]["numInputRows"] if recent else 0,
        "total_rows": sum(p["numInputRows"] for p in recent),
        "active": query.isActive,
    }


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool | None:
    """Wait until one of the running queries ends."""
    return spark.streams.awaitAnyTermination(timeout_s) if timeout_s else spark.streams.awaitAnyTermination()
