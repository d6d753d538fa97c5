"""Structured Streaming over the tables as file streams; every query runs until all input is read."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import stage_folder
from ..sources.files import read_table
from ..sources.messages import publish_stream, read_stream, to_folders
from ..streaming.ingest import Topic, ingest_available, write_stream
from ..streaming.live import stream_dedup, stream_join_on_grain, stream_refresh, stream_resample, window_start
from .base import query, round_all, rounded_sql, table

def _base(spark, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _stream(spark, sf):
    """``events`` as a file stream. Without a rate limit all files come in one micro-batch, so the answer
    does not depend on the order in which files were written."""
    schema = table(spark, sf, "events").schema
    # a glob, since a file stream takes a folder or a pattern and the table may be a file or a folder
    stream = read_stream(spark, "parquet", f"{sf}/event[s].parquet", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _closed(spark, sdf):
    """The stream with one row more, whose time lies beyond all others. It moves the watermark past every window
    of a bounded replay, so that the last ones come out as well; its own window stays open."""
    path = f"{_base(spark, 'end')}/row"
    schema = sdf.schema
    values = {"ts": "timestamp '2200-01-01 00:00:00'", "user_id": "-1"}
    row = [F.expr(values.get(f.name, "null")).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*row).write.parquet(path)
    return sdf.unionByName(read_stream(spark, "parquet", path, schema))


def _drained(spark, sdf, name: str):
    base = _base(spark, name)
    write_stream(sdf, f"{base}/out", f"{base}/checkpoint", "available").awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{base}/out")


_CONTENT = ["event_id", "user_id", "event_type", "value", "props"]
_DATA_SETS = {"first": "sensors", "second": "sensors", "lab": "targets"}  # two data sets share a topic
_TAG = "case when event_type = 'purchase' then 'lab' when event_id % 2 = 0 then 'first' else 'second' end"


def _schema(columns) -> T.StructType:
    kinds = {"event_id": T.LongType(), "user_id": T.LongType(), "value": T.DoubleType()}
    schema = T.StructType().add("dt", T.StringType())
    for c in [*columns, "source_type"]:
        schema = schema.add(c, kinds.get(c, T.StringType()))
    return schema


def _published(spark, sf, base: str) -> dict[str, Topic]:
    """All events as messages in the folder of their data set's topic; targets have a schema of their own."""
    rows = _stream(spark, sf).selectExpr("ts as dt", *_CONTENT, f"{_TAG} as source_type")
    for _ in range(2):  # the second run finds nothing new
        publish_stream(rows, _DATA_SETS, to_folders(f"{base}/messages"), f"{base}/published").awaitTermination()
    schemas = {"sensors": _schema(_CONTENT), "targets": _schema(["event_id", "value"])}
    return {
        name: Topic(schema, name, {"kind": "text", "path": f"{base}/messages/topic={name}/*"}) for name, schema in schemas.items()
    }


_PARTS = "cast(year(ts) as integer) as year, cast(month(ts) as integer) as month, cast(day(ts) as integer) as day"
_READINGS = f"select {', '.join(_CONTENT)}, {_TAG} as source_type, {_PARTS} from events where event_type <> 'purchase'"
_LAB = f"select event_id, null::bigint, null::varchar, value, null::varchar, 'lab', {_PARTS} from events where event_type = 'purchase'"


@query("stream_ingest", f"{_READINGS} union all {_LAB}")
def stream_ingest(spark, sf):
    base = _base(spark, "ingest")
    topics = _published(spark, sf, base)
    ingest_available(spark, topics, base)
    parts = [*_CONTENT, "source_type", "year", "month", "day"]
    both = read_table(spark, f"{base}/sensors").unionByName(read_table(spark, f"{base}/targets"), allowMissingColumns=True)
    return both.select(*parts)


@query(
    "stream_ingest_topics",
    """select case when event_type = 'purchase' then 'targets' else 'sensors' end as topic, count(*) as n,
  cast(day(ts) as integer) as day from events group by all""",
)
def stream_ingest_topics(spark, sf):
    base = _base(spark, "ingest")
    topics = _published(spark, sf, base)
    ingest_available(spark, topics, base)
    ingest_available(spark, topics, base)  # continues from the checkpoints: nothing arrives twice
    counts = [
        read_table(spark, f"{base}/{name}").groupBy(F.lit(name).alias("topic"), "day").agg(F.count(F.lit(1)).alias("n"))
        for name in topics
    ]
    return counts[0].unionByName(counts[1])


@query(
    "stream_progress",
    """select topic, count(*) as total_rows, true as several_batches from (
  select case when event_type = 'purchase' then 'targets' else 'sensors' end as topic from events) group by topic""",
)
def stream_progress(spark, sf):
    """Rows that the progress of each topic's query adds up to, read in one micro-batch a file."""
    base = _base(spark, "progress")
    topics = _published(spark, sf, base)
    slow = {n: replace(t, source={**t.source, "rate_limit": 1}) for n, t in topics.items()}
    for name, t in topics.items():  # several files a topic
        spark.read.text(t.source["path"]).repartition(6).write.text(f"{base}/split/{name}")
        slow[name] = replace(slow[name], source={**slow[name].source, "path": f"{base}/split/{name}"})
    found = ingest_available(spark, slow, base)
    rows = [(n, p["total_rows"], p["batches"] > 3) for n, p in found.items()]
    return spark.createDataFrame(rows, "topic string, total_rows long, several_batches boolean")


@query(
    "stream_resample",
    f"""with h as (select date_trunc('hour', ts) as hour, user_id % 5 as line, avg(value) as value, max(event_id) as event_id
  from events group by 1, 2)
select cast(hour as timestamp) as hour, line, {rounded_sql('value')} as value, event_id from h""",
)
def resample_stream(spark, sf):
    sdf = _closed(spark, _stream(spark, sf)).withColumn("line", F.expr("user_id % 5"))
    hourly = stream_resample(sdf, "ts", "1 hour", {"value": "avg", "event_id": "max"}, "1 hour", ["line"])
    return round_all(_drained(spark, window_start(hourly, "hour"), "resample"), ["value"])


@query(
    "stream_join_on_hour",
    f"""with a as (select date_trunc('hour', ts) as hour, avg(value) as value from events group by 1),
b as (select date_trunc('hour', ts) as hour, max(event_id) as target_id from events where event_type = 'purchase' group by 1)
select cast(hour as timestamp) as hour, {rounded_sql('value')} as value, target_id from a join b using (hour)""",
)
def join_stream(spark, sf):
    left = stream_resample(_closed(spark, _stream(spark, sf)), "ts", "1 hour", {"value": "avg"})
    right = _closed(spark, _stream(spark, sf).where("event_type = 'purchase'"))
    right = right.withColumnRenamed("event_id", "target_id")
    right = stream_resample(right, "ts", "1 hour", {"target_id": "max"})
    joined = window_start(stream_join_on_grain(left, right), "hour")
    return round_all(_drained(spark, joined, "join"), ["value"])


@query("stream_dedup", "select event_id, value from events")
def dedup_stream(spark, sf):
    sdf = _stream(spark, sf)
    twice = sdf.unionByName(_stream(spark, sf))
    return _drained(spark, stream_dedup(twice, "ts", ["event_id"], "1 hour").select("event_id", "value"), "dedup")


_SEC = "epoch_us(ts) // 1000000"
_W = "(partition by user_id order by ts, event_id)"


@query(
    "stream_refresh",
    f"""with v as (select *, lag(value) over w as value_lag_1h, value - lag(value) over w as value_diff_1h,
  ({_SEC} - lag({_SEC}) over w) / 3600e0 + 1e-5 as h from events window w as {_W}),
u as (select *, value_diff_1h / h as value_velocity from v),
a as (select *, (value_velocity - lag(value_velocity) over w) / h as value_acceleration from u window w as {_W})
select user_id, ts, value, value_lag_1h, {rounded_sql('value_diff_1h')} as value_diff_1h,
  {rounded_sql('value_velocity', 4)} as value_velocity, {rounded_sql('value_acceleration', 2)} as value_acceleration
from a""",
)
def refresh_stream(spark, sf):
    fresh = stream_refresh(_closed(spark, _stream(spark, sf)), "ts", ["value"], ["user_id"], "1 hour")
    out = _drained(spark, fresh, "refresh").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return round_all(out, {"value_diff_1h": 6, "value_velocity": 4, "value_acceleration": 2})
