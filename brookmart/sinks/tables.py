"""Writing dimension and result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from brookmart.operators.changelog import latest_config, latest_dim_rows
from brookmart.schemas import CONFIG
from brookmart.sinks.topics import TRIGGER, run_id, start

# A dimension table is rewritten to its current rows every so many micro-batches.
FOLD_EVERY = 100


def sink_projection(df: DataFrame) -> DataFrame:
    """All columns but those marked as not for sinks."""
    return df.select([f.name for f in df.schema if f.metadata.get("sink", True)])


def _write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Add a micro-batch to a table; a repeated one replaces its own earlier rows."""
    marked = (rows.withColumn("run", F.lit(run_id(rows.sparkSession)))
                  .withColumn("batch_id", F.lit(batch_id)))
    _write_partitions(marked, path, ["run", "batch_id"])


def write_waiting(rows: DataFrame, path: str) -> None:
    """The rows that a micro-batch leaves to the next one; an empty table if there are none.

    The folder is replaced whole, so nothing of an earlier try of the batch stays.
    """
    rows.write.mode("overwrite").parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Rows as stored, however many epochs and tables there are, none included.
DIM_STORE = ("pk array<string>, data map<string,string>, ts bigint, xid bigint, xoffset bigint, "
             "sink_table string, epoch int, batch_id long")


def stored_dims(spark: SparkSession, root: str) -> DataFrame:
    """All versions that the dimension tables hold; none if nothing was ever written."""
    try:
        return spark.read.schema(DIM_STORE).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DIM_STORE)


def upsert_dim(rows: DataFrame, batch_id: int, root: str, fold_every: int = FOLD_EVERY) -> None:
    """Add one micro-batch of dimension upserts, for all tables in one write.

    A batch adds its newest row per key; readers take the newest of the newest epoch, and a
    new epoch begins with the current rows of the one before once that holds `fold_every`
    batches.  So a batch costs what it holds and not what the table holds.  The epoch follows
    from what is stored, not from the batch's number: after a lost checkpoint numbers begin
    again, and rows still go where readers look.  Repeating a batch is harmless: versions are
    ordered by their place in the changelog, equal ones collapse.

    Rows whose key is null or partly null go to the folder `<root>_rejected`.
    """
    spark = rows.sparkSession
    whole = F.coalesce((F.size("pk") > 0) & ~F.exists("pk", lambda k: k.isNull()), F.lit(False))
    write_batch(rows.where(~whole), f"{root}_rejected", batch_id)
    stored = stored_dims(spark, root)
    epochs = stored.groupBy("epoch").agg(F.countDistinct("batch_id").alias("batches"))
    newest = epochs.orderBy(F.desc("epoch")).first()
    epoch = newest["epoch"] if newest else 0
    latest = latest_dim_rows(rows.where(whole))
    if newest and newest["batches"] >= fold_every:
        old = stored.where(F.col("epoch") == epoch).select(latest.columns)
        latest, epoch = latest_dim_rows(old.unionByName(latest)), epoch + 1
    marked = (latest.withColumn("epoch", F.lit(epoch))
              .withColumn("batch_id", F.unix_micros(F.current_timestamp())))
    _write_partitions(marked, root, ["sink_table", "epoch", "batch_id"])


def write_stats(stats: DataFrame, path: str, checkpoint: str, mode: str = "append",
                trigger: str | None = TRIGGER) -> StreamingQuery:
    """Stream of statistics to a Parquet table partitioned by day.

    Each micro-batch owns a partition under the day, so a repeated one adds nothing twice.
    In update mode the table keeps every refreshed total; read it with `latest_version`.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        kept = (sink_projection(batch).withColumn("day", F.substring("stt", 1, 10))
                .withColumn("run", F.lit(run_id(batch.sparkSession)))
                .withColumn("batch_id", F.lit(batch_id)))
        _write_partitions(kept, path, ["day", "run", "batch_id"])

    return start(stats.writeStream.outputMode(mode).foreachBatch(write_batch),
                 checkpoint, trigger)


def compact_day(spark: SparkSession, path: str, day: str, files: int = 1) -> None:
    """Rewrite one closed day of a result table as one folder of `files` files.

    The day is staged beside the table first, so a run that breaks off can be repeated:
    what it replaces is read from the stage.  Only for days that no query writes any more.
    """
    stage = f"{path}_compacting/{day}"
    rows = spark.read.parquet(path).where(F.col("day") == day).drop("day", "run", "batch_id")
    rows.coalesce(files).write.mode("overwrite").parquet(stage)
    (spark.read.parquet(stage)
        .withColumn("run", F.lit("compacted")).withColumn("batch_id", F.lit(0))
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("run", "batch_id").parquet(f"{path}/day={day}"))


def store_config(changes: DataFrame, root: str) -> None:
    """Fold configuration changes into the stored configuration.

    Every fold writes all rows in force as a new version, which appears with one rename;
    readers take the newest, so none sees half a table.
    """
    spark = changes.sparkSession
    columns = ["kind", *CONFIG.names, "seq"]
    schema = StructType([*CONFIG, StructField("seq", LongType()), StructField("version", LongType())])
    try:
        stored = spark.read.schema(schema).parquet(root)
        newest = stored.agg(F.max("version")).first()[0]
        old = stored.where(F.col("version") == newest).withColumn("kind", F.lit("+I"))
        changes = old.select(columns).unionByName(changes.select(columns))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest, changes = 0, changes.select(columns)
    kept = latest_config(changes.withColumn("_seq", F.col("seq")), ("seq",)).withColumnRenamed(
        "_seq", "seq")
    _write_partitions(kept.withColumn("version", F.lit((newest or 0) + 1).cast("long")), root,
                      ["version"])


def write_stats_jdbc(stats: DataFrame, url: str, table: str, checkpoint: str,
                     mode: str = "append", trigger: str | None = TRIGGER,
                     **options: str) -> StreamingQuery:
    """Stream of statistics appended to a database table, 1024 rows a round trip.

    A failed task is retried whole, so delivery is at least once.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (sink_projection(batch).write.format("jdbc").mode("append")
            .options(url=url, dbtable=table, batchsize="1024", **options).save())

    return start(stats.writeStream.outputMode(mode).foreachBatch(write_batch),
                 checkpoint, trigger)
