"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  The skew settings let AQE cut a hot join
# partition into pieces even where that costs one more exchange further up.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Give a session that already exists the runtime settings its user has not chosen."""
    chosen = spark.sparkContext.getConf()
    for key, value in RUNTIME_CONF.items():
        if chosen.get(key) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "brookmart", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session for running jobs; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="brookmart-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by `spark.checkpoint.dir`.

    Only a local session may go without the setting.
    """
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Used where several branches read one costly result, as the layers of a
    warehouse do.  The table survives executor loss, is read with column pruning,
    and its file size is what lets the planner decide on a broadcast.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brookmart/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
