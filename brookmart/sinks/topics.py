"""Writing JSON text to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from brookmart.sources.topics import TopicStore

TRIGGER = "3 seconds"


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None = TRIGGER,
          name: str | None = None) -> StreamingQuery:
    """Start a query that can be restarted from `checkpoint`.

    `trigger=None` works off what is there and stops.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_id(spark: SparkSession) -> str:
    """Which query writes: its checkpoint's id, kept over restarts and new after a reset.

    Batch numbers begin again with a new checkpoint; with this beside them, an earlier
    run's output is never replaced.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def kafka_write_options(store: TopicStore) -> dict[str, str]:
    return {"kafka.bootstrap.servers": store.location,
            "kafka.transaction.timeout.ms": str(15 * 60 * 1000), **store.options}


def write_topic(df: DataFrame, topic: str, store: TopicStore, checkpoint: str,
                trigger: str | None = TRIGGER) -> StreamingQuery:
    """Stream of `value` to one topic.

    The file sink is exactly-once; Kafka's is at-least-once.
    """
    if store.kind == "kafka":
        writer = (df.select(F.lit(topic).alias("topic"), "value").writeStream
                    .format("kafka").options(**kafka_write_options(store)))
    else:
        writer = (df.select("value").writeStream.format("text")
                    .option("path", store.folder(topic)))
    return start(writer.outputMode("append"), checkpoint, trigger, topic)


def write_by_topic(df: DataFrame, job: str, store: TopicStore, checkpoint: str,
                   trigger: str | None = TRIGGER) -> StreamingQuery:
    """Stream of (topic, value), each row to the topic it names.

    With files all topics of the job share the folder `job`, one partition per topic.
    """
    writer = df.select("topic", "value").writeStream
    if store.kind == "kafka":
        writer = writer.format("kafka").options(**kafka_write_options(store))
    else:
        writer = (writer.format("text").partitionBy("topic")
                        .option("path", f"{store.location}/{job}"))
    return start(writer.outputMode("append"), checkpoint, trigger, job)


def create_topic(spark: SparkSession, topic: str, job: str, store: TopicStore) -> None:
    """Make an empty part of a topic, if topics are files, so that readers find its folders."""
    if store.kind != "kafka":
        (spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite")
              .text(f"{store.location}/{job}/topic={topic}/run=none/batch_id=0"))


def write_batch_by_topic(batch: DataFrame, batch_id: int, job: str, store: TopicStore) -> None:
    """`write_by_topic` for use inside a micro-batch function.

    With files a repeated batch replaces its own earlier output.
    """
    rows = batch.select("topic", "value")
    if store.kind == "kafka":
        rows.write.format("kafka").options(**kafka_write_options(store)).save()
        return
    (rows.withColumn("run", F.lit(run_id(batch.sparkSession)))
         .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "run", "batch_id")
         .text(f"{store.location}/{job}"))


def show_stream(df: DataFrame, name: str | None = None, mode: str = "append") -> StreamingQuery:
    """Print a stream, or keep it in memory as table `name`."""
    writer = df.writeStream.outputMode(mode)
    if name:
        return writer.format("memory").queryName(name).start()
    return writer.format("console").option("truncate", "false").start()
