"""Database change records: cleaning, configuration, pruning and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.functions.records import parse_once
from brookmart.operators.firsts import latest_version
from brookmart.schemas import CHANGELOG, SINK_DIM, SINK_TOPIC

CHANGE_ORDER = ("ts", "xid", "xoffset")


def changelog_etl(df: DataFrame, database: str = "shop", value: str = "value") -> DataFrame:
    """Usable inserts and updates of one database.

    Snapshot records ('bootstrap-insert') count as inserts: the prefix is removed from
    the whole message before parsing.  `data` stays JSON text.
    """
    message = F.regexp_replace(F.col(value), "bootstrap-", "")
    return (df.select(parse_once(message, CHANGELOG))
              .where((F.col("database") == database)
                     & F.col("table").isNotNull()
                     & F.col("type").isin("insert", "update")
                     & (F.length("data") > 2)))


def latest_config(changes: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Configuration in force: the latest row per (source_table, operate_type).

    `changes` has the config columns, a row `kind` and order columns.  Before-images
    ('-U') and deletes ('-D') are ignored, so a deleted row stays in force.
    """
    added = changes.where(F.col("kind").isin("+I", "+U"))
    latest = latest_version(added, ["source_table", "operate_type"], order[0], order[1:])
    return latest.drop("kind", *order)


def config_warnings(config: DataFrame) -> DataFrame:
    """Config rows whose column list has blanks around a comma; those columns are lost."""
    return config.where(F.col("sink_columns").rlike(r"\s,|,\s|^\s|\s$"))


def join_config(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Each change with its configuration; changes of unconfigured tables are dropped.

    Hand in the config as a stored table: its file size tells the planner whether it may
    be broadcast.
    """
    c = config.alias("c")
    on = ((F.col("d.table") == F.col("c.source_table"))
          & (F.col("d.type") == F.col("c.operate_type")))
    return changes.alias("d").join(c, on).select("d.*", "c.*")


def prune_columns(df: DataFrame, data: str = "data", columns: str = "sink_columns") -> DataFrame:
    """Keep the keys of the JSON text `data` listed in the row's own column list.

    The list is cut at commas and not trimmed.  Values keep their JSON types.  Rows whose
    `data` is no JSON object with distinct keys are left out; see `is_object`.
    """
    kept = F.expr(f"""
        to_json(map_filter(try_cast(try_parse_json({data}) as map<string, variant>),
                           (k, v) -> array_contains(split({columns}, ','), k)))""")
    return (df.withColumn("whole", F.col(data)).withColumn(data, kept)
              .where(F.col(data).isNotNull()))


def route_by_sink(df: DataFrame) -> DataFrame:
    """Add `route`: 'topic' or 'dim'; other sink types are dropped."""
    route = (F.when(F.col("sink_type") == SINK_TOPIC, "topic")
              .when(F.col("sink_type") == SINK_DIM, "dim"))
    return df.withColumn("route", route).where(F.col("route").isNotNull())


def topic_rows(routed: DataFrame) -> DataFrame:
    """(topic, value) of the rows bound for topics."""
    return (routed.where(F.col("route") == "topic")
                  .select(F.col("sink_table").alias("topic"), F.col("data").alias("value")))


def dim_rows(routed: DataFrame) -> DataFrame:
    """Dimension upserts: table, primary key values and all columns as text.

    The key is taken from the record before pruning (`whole`), if that is there, so it need
    not be a kept column.

    The key columns default to `id`; a composite key is a comma list.
    """
    data = F.from_json("data", "map<string,string>")
    before = "whole" if "whole" in routed.columns else "data"
    key_names = F.transform(F.split(F.coalesce("sink_pk", F.lit("id")), ","), F.trim)
    return (routed.where(F.col("route") == "dim")
                  .withColumn("whole", F.from_json(before, "map<string,string>"))
                  .withColumn("data", data)
                  .select("sink_table",
                          F.transform(key_names, lambda k: F.col("whole")[k]).alias("pk"),
                          "data", *CHANGE_ORDER))


def latest_dim_rows(rows: DataFrame) -> DataFrame:
    """The newest version of each dimension row, by position in the changelog."""
    return latest_version(rows, ["sink_table", "pk"], CHANGE_ORDER[0], CHANGE_ORDER[1:])
