"""Stored tables: dimensions and configuration."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmart.operators.changelog import CHANGE_ORDER
from brookmart.operators.firsts import latest_version
from brookmart.sinks.tables import stored_dims


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; give partitionColumn, lowerBound, upperBound and numPartitions
    to read a large one in parallel.  Needs the database's driver on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_dim(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    """Current rows of one dimension written by `upsert_dim`, all columns text."""
    stored = stored_dims(spark, root)
    # The newest epoch over all tables: a fold carries every table over.  Both the maximum
    # and the filter read folder names only.
    epoch = stored.agg(F.max("epoch")).first()[0]
    rows = stored.where((F.col("sink_table") == table) & (F.col("epoch") == F.lit(epoch)))
    current = latest_version(rows, ["pk"], CHANGE_ORDER[0], [*CHANGE_ORDER[1:], "batch_id"])
    return current.select([F.col("data")[c].alias(c) for c in columns])


def read_waiting(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `write_waiting` wrote; no rows if the folder is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The configuration as stored now; call it once per micro-batch to see changes.

    Of a table with versions the newest is read.
    """
    stored = spark.read.parquet(path)
    if "version" not in stored.columns:
        return stored
    newest = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == newest).drop("seq", "version")
