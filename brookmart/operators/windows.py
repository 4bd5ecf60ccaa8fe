"""Event time, tumbling windows and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.functions.times import duration_ms
from brookmart.schemas import DATETIME


def with_event_time(df: DataFrame, at: Column, delay: str, name: str = "et") -> DataFrame:
    """Add the event-time column and its watermark."""
    return df.withColumn(name, at).withWatermark(name, delay)


def tumble(ts: str, size: str) -> Column:
    return F.window(ts, size).alias("window")


def window_bounds(df: DataFrame, fmt: str = DATETIME, window: str = "window") -> DataFrame:
    """Add the bounds of the window as text `stt` and `edt`."""
    return (df.withColumn("stt", F.date_format(f"{window}.start", fmt))
              .withColumn("edt", F.date_format(f"{window}.end", fmt)))


def count_once(df: DataFrame, window: Column, keys: Sequence[str], ids: dict[str, str],
               sums: Sequence[str], carries: str | None = None) -> DataFrame:
    """Sums and exact distinct counts per window and keys, for batch and stream.

    `ids` maps output names to id columns; a row carries at most one id.  The first
    aggregation brings all rows of one id together, the second counts what is left.  No
    set of ids is ever held for a group, and a hot key is spread by its ids.  Rows without
    an id are one group of the first aggregation, added up before its shuffle.

    `carries` names a boolean column that is false for rows known to have no id.  In a batch
    these go to the second aggregation at once; it should be a literal in each part of a
    union, so that no part is read twice.
    """
    added = [F.expr(f"sum({c}) as {c}") for c in sums]
    grouping = ["window", *keys, *ids.values()]

    def by_id(part: DataFrame) -> DataFrame:
        return part.select(window, *keys, *ids.values(), *sums).groupBy(*grouping).agg(*added)

    if carries and not df.isStreaming:
        rest = df.where(f"not {carries}").select(window, *keys, *ids.values(), *sums)
        rows = by_id(df.where(carries)).unionByName(rest)
    else:
        rows = by_id(df)
    return rows.groupBy("window", *keys).agg(
        *added, *[F.expr(f"count({c}) as {out}") for out, c in ids.items()])


def window_end_ms(ts: Column | str, window: str) -> Column:
    """End of a time's tumbling window as epoch milliseconds; unlike `window` it drops no row
    without a time."""
    size = duration_ms(window)
    at = F.unix_millis(ts)
    return at - F.pmod(at, F.lit(size)) + size


def is_late(ts: Column | str, seen: Column | str, window: str, delay: str = "0 seconds") -> Column:
    """Whether a row's tumbling window had been closed for `delay` or longer at the time `seen`.

    A row without a time, or where `seen` is null, is not late.
    """
    closed = window_end_ms(ts, window) + duration_ms(delay)
    return F.coalesce(closed <= F.unix_millis(seen), F.lit(False))


def split_late(df: DataFrame, ts: str, seen: str, window: str,
               delay: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late) of rows that carry the time `seen` at which they arrived."""
    marked = df.withColumn("_late", is_late(ts, seen, window, delay))
    return marked.where("not _late").drop("_late"), marked.where("_late").drop("_late")


def lateness(df: DataFrame, ts: str, seen: str, window: str, delay: str) -> DataFrame:
    """Rows on time and late of each window, and how long after its end the last one came."""
    behind = F.unix_millis(seen) - window_end_ms(ts, window)
    marked = df.select(tumble(ts, window), is_late(ts, seen, window, delay).alias("late"),
                       behind.alias("behind"))
    return marked.groupBy("window").agg(
        F.count_if(~F.col("late")).alias("on_time_ct"), F.count_if("late").alias("late_ct"),
        F.greatest(F.max("behind"), F.lit(0)).alias("last_behind_ms"))
