"""First and latest rows of a key.

`tie` names columns that, together with the key and the time, identify one record
(a topic position for instance); they settle which of two simultaneous records is first.

The row-number filters below are planned with a group limit before the shuffle, so a
key holding a large share of the rows is cut to one row per task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.functions.times import day_of


def _top_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def earliest(df: DataFrame, keys: Sequence[str | Column], ts: str,
             tie: Sequence[str] = ()) -> DataFrame:
    """The whole row with the smallest time of each group."""
    return _top_one(df, keys, [F.col(c).asc() for c in (ts, *tie)])


def latest_version(df: DataFrame, keys: Sequence[str | Column], ts: str,
                   tie: Sequence[str] = ()) -> DataFrame:
    """The whole row with the largest time of each group."""
    return _top_one(df, keys, [F.col(c).desc() for c in (ts, *tie)])


def daily_uv(pages: DataFrame, key: str = "mid", ts: str = "ts",
             tie: Sequence[str] = ("pos",), zone: str | None = None) -> DataFrame:
    """Earliest record of each device on each day of `zone`, or of the session's time zone."""
    at = F.timestamp_millis(ts)
    day = day_of(at, zone) if zone else F.to_date(at)
    return earliest(pages, [key, day], ts, tie)


def flag_new_visitor(logs: DataFrame, key: str = "mid", ts: str = "ts",
                     tie: Sequence[str] = ("pos",), flag: str = "is_new") -> DataFrame:
    """Set `flag` to '1' on a device's first record ever and '0' on all others.

    The first time of each device is aggregated on its own (map-side combined, three
    narrow columns) and joined back on (key, time, tie).  Those join keys are spread
    evenly however many records one device has, which a window over the device is not.
    """
    at = [ts, *tie]
    first = (logs.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*at)).alias("_f"))
                 .select("_k", *[F.col(f"_f.{c}").alias(f"_f_{c}") for c in at]))
    same = F.col(key) == F.col("_k")
    for c in at:
        same = same & (F.col(c) == F.col(f"_f_{c}"))
    joined = logs.join(first, same, "left")
    return (joined.withColumn(flag, F.when(F.col("_k").isNotNull(), "1").otherwise("0"))
                  .drop(*first.columns))
