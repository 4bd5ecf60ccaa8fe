"""Topics: streams of JSON text, from Kafka or from folders of text files.

Every reader gives `value` (the text) and `pos`, a number that tells records of equal time
apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.functions.records import parse_typed
from brookmart.operators.windows import with_event_time


@dataclass(frozen=True)
class TopicStore:
    """Where topics live.

    `kind` is 'kafka' (`location` = bootstrap servers) or 'files' (`location` = a folder
    with one folder per topic).  `shared` names, for topics written together by one
    job, the folder they share.
    """

    kind: str
    location: str
    shared: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)

    def folder(self, topic: str) -> str:
        return f"{self.location}/{self.shared.get(topic, topic)}"


def kafka_read_options(store: TopicStore, topic: str, start: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": store.location, "subscribe": topic,
            "startingOffsets": start, "kafka.isolation.level": "read_committed",
            **store.options}


def _kafka_rows(loaded: DataFrame) -> DataFrame:
    # Offsets are unique within a partition; partitions take the last five digits.
    return loaded.select(F.col("value").cast("string").alias("value"),
                         (F.col("offset") * 100_000 + F.col("partition")).alias("pos"))


def read_topic(spark: SparkSession, topic: str, store: TopicStore,
               start: str = "latest") -> DataFrame:
    """Unbounded stream of one topic; only committed records.

    A folder has no 'latest': files already there are read too.
    """
    if store.kind == "kafka":
        return _kafka_rows(spark.readStream.format("kafka")
                           .options(**kafka_read_options(store, topic, start)).load())
    schema = "value string"
    if topic in store.shared:
        schema += ", topic string"
    lines = (spark.readStream.format("text").schema(schema).options(**store.options)
                  .load(store.folder(topic)))
    if topic in store.shared:
        lines = lines.where(F.col("topic") == topic)
    return lines.select("value", F.xxhash64("value").alias("pos"))


def read_topics(spark: SparkSession, topics: Iterable[str], store: TopicStore,
                start: str = "latest") -> dict[str, DataFrame]:
    return {t: read_topic(spark, t, store, start) for t in topics}


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` from the text of topic rows."""
    return parse_typed(rows.select("value"), schema)


def topic_table(spark: SparkSession, topic: str, schema: T.StructType, store: TopicStore,
                start: str = "latest", event_time: Column | None = None,
                delay: str = "3 seconds", view: str | None = None) -> DataFrame:
    """A topic as a typed table, named for SQL, with event time if asked for."""
    table = typed(read_topic(spark, topic, store, start), schema)
    if event_time is not None:
        table = with_event_time(table, event_time, delay)
    table.createOrReplaceTempView(view or topic)
    return table


def from_elements(spark: SparkSession, rows: Sequence[str]) -> DataFrame:
    """A few literal records, for trying a job."""
    return spark.createDataFrame([(text, i) for i, text in enumerate(rows)],
                                 "value string, pos bigint")


def read_ods_log(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Client log lines from day-rolled files `app.<date>.log`."""
    if stream:
        lines = spark.readStream.format("text").option("pathGlobFilter", "app.*.log").load(folder)
        return lines.select("value", F.xxhash64("value").alias("pos"))
    lines = spark.read.option("pathGlobFilter", "app.*.log").text(folder)
    # Numbered by file split and line, so copies of a line stay apart.
    return lines.select("value", F.monotonically_increasing_id().alias("pos"))
