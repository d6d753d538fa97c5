"""JSON messages: decoding, encoding and the message-bus source and sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """One JSON document per row to flat columns. A malformed document gives a row of NULLs."""
    return df.select(F.from_json(F.col(value_col).cast("string"), schema).alias("d")).select("d.*")


def encode_json(df: DataFrame, tag: str | None = None, ts: str = "dt", tag_col: str = "source_type") -> DataFrame:
    """Rows to JSON documents in a ``value`` column, the time as text and the data-set tag added."""
    cols = [F.col(c).cast("string").alias(c) if c == ts else F.col(c) for c in df.columns if c != tag_col]
    if tag is not None:
        cols.append(F.lit(tag).alias(tag_col))
    elif tag_col in df.columns:
        cols.append(F.col(tag_col))
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send encoded messages to a topic."""
    df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def route(df: DataFrame, topics: Mapping[str, str], tag_col: str = "source_type", ts: str = "dt") -> DataFrame:
    """Rows as ``topic`` and ``value``: the data set of a row (``tag_col``) decides its topic.

    ``topics`` maps data sets to topics, several of which may share one. Rows of data sets without a topic, NULL
    among them, are left out; ``unrouted`` finds them.
    """
    known = df.where(F.col(tag_col).isin(*topics))
    topic = F.lit(None).cast("string")
    for name, to in topics.items():
        topic = F.when(F.col(tag_col) == name, F.lit(to)).otherwise(topic)
    columns = [F.col(c).cast("string").alias(c) if c == ts else F.col(c) for c in df.columns]
    return known.select(topic.alias("topic"), F.to_json(F.struct(*columns)).alias("value"))


def unrouted(df: DataFrame, topics: Mapping[str, str], tag_col: str = "source_type") -> DataFrame:
    """Rows that no topic takes."""
    return df.where(F.col(tag_col).isNull() | ~F.col(tag_col).isin(*topics))


def to_broker(servers: str) -> Callable[[DataFrame, int], None]:
    """A sink of routed messages for ``publish_stream``: each goes to the topic that its row names, with the batch
    in a header, since a broker does not know which batches it has."""

    def send(messages: DataFrame, batch_id: int) -> None:
        header = F.array(F.struct(F.lit("batch").alias("key"), F.lit(str(batch_id)).cast("binary").alias("value")))
        rows = messages.select("topic", "value", header.alias("headers"))
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("includeHeaders", "true").save()

    return send


def to_folders(base: str) -> Callable[[DataFrame, int], None]:
    """A sink of routed messages for ``publish_stream``: text files in a folder for each topic and batch. A repeated
    batch replaces its own folders, so nothing is written twice."""

    def send(messages: DataFrame, batch_id: int) -> None:
        placed = messages.select("value", "topic", F.lit(batch_id).alias("batch"))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("topic", "batch").text(base)

    return send


def publish_stream(
    rows: DataFrame,
    topics: Mapping[str, str],
    send: Callable[[DataFrame, int], None],
    checkpoint: str,
    tag_col: str = "source_type",
    ts: str = "dt",
) -> StreamingQuery:
    """Publish all that a stream of rows holds, each row to its data set's topic, and stop.

    A batch that failed half-way is sent again under the same id after a restart from ``checkpoint``.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        send(route(batch, topics, tag_col, ts), batch_id)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stream(
    spark: SparkSession,
    kind: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    rate_limit: int | None = None,
) -> DataFrame:
    """Streaming source. ``kafka`` subscribes to a topic from the earliest offset and goes on when data
    was lost; any other kind is a file format read from ``path``. ``rate_limit`` caps a micro-batch
    (offsets for kafka, files otherwise)."""
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
        )
        return (reader.option("maxOffsetsPerTrigger", rate_limit) if rate_limit else reader).load()
    reader = spark.readStream.format(kind)
    reader = reader.schema(schema) if schema else reader
    return (reader.option("maxFilesPerTrigger", rate_limit) if rate_limit else reader).load(path)
