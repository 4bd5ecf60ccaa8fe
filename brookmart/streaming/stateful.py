"""Streaming forms of the per-key operators.

Batch forms use window functions, which streams do not have.  Here event-time windows bring a
key's records together, in the JVM and for a bounded stretch of time:

- A two-step sequence collects each key's records over buckets that overlap by the limit, so a
  bucket holds what may follow its last records.  Buckets are narrower than the limit: a busy
  key's groups are bounded by the limit and a little, and results hardly wait for them.
- First records are the least (time, position) of each key and window.  Only that row of two
  numbers meets the state that knows which keys, or keys and days, have come before; records
  themselves are joined to it afterwards by key, time and position, which no key makes hot.

Record text stays in the JVM throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brookmart.functions.times import day_of, duration_ms, event_time
from brookmart.operators.sequence import MATCHED, TIMED_OUT, is_entry, step_outcome

PARTS = 4       # buckets in a sequence's limit: more come out sooner and copy more rows
_FIRST = "_key string, _ts long, _pos long, _closed timestamp"


class FirstSeen(StatefulProcessor):
    """Passes on a key's first row, and with `by_day` the first of each day.

    Rows are the first records of one key's windows.  The state of a day goes once the
    watermark has passed the end of it: what comes later is late.
    """

    def __init__(self, by_day: bool) -> None:
        self.by_day = by_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day string, ends long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        found = []
        for row in sorted(rows, key=lambda r: (r._ts, r._pos)):
            if last is None or (self.by_day and row._day > last[0]):
                last = (row._day, row._ends)
                found.append(Row(_key=key[0], _ts=row._ts, _pos=row._pos, _closed=row._closed))
        if found:
            self.last.update(tuple(last))
            if self.by_day:
                now = timerValues.getCurrentWatermarkInMs()
                self.handle.registerTimer(max(last[1], now + 1))
        yield from found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A timer of a day before the last one finds a later end, and leaves it.
        if self.last.exists() and self.last.get()[1] <= timerValues.getCurrentWatermarkInMs():
            self.last.clear()
        yield from ()


def first_records(df: DataFrame, key: str, ts: str, pos: str, window: str, delay: str,
                  by_day: bool = False, zone: str | None = None) -> DataFrame:
    """`(_key, _ts, _pos, _closed)`: the first record of each key, or key and day.

    It comes out when the watermark has passed the window that holds it.
    """
    at = event_time(ts)
    day = day_of(at, zone) if by_day else F.lit("")
    heads = (df.select(F.col(key).cast("string").alias("_key"), at.alias("_et"), day.alias("_day"),
                       F.struct(F.col(ts).alias("ts"), F.col(pos).alias("pos")).alias("_at"))
             .where("_key is not null").withWatermark("_et", delay)
             .groupBy(F.window("_et", window), "_key", "_day").agg(F.min("_at").alias("_at")))
    # A day lasts at most 25 hours after its first record, in any zone.
    rows = heads.select("_key", "_day", F.col("_at.ts").alias("_ts"), F.col("_at.pos").alias("_pos"),
                        (F.col("_at.ts") + duration_ms("25 hours")).alias("_ends"),
                        F.window_time("window").alias("_closed"))
    return rows.groupBy("_key").transformWithState(
        statefulProcessor=FirstSeen(by_day), outputStructType=_FIRST, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="_closed")


def _joined(df: DataFrame, firsts: DataFrame, how: str, key: str, ts: str, pos: str, window: str,
            delay: str) -> DataFrame:
    """Records with the row of `firsts` that is theirs."""
    rows = df.withColumn("_et", event_time(ts)).withWatermark("_et", delay)
    same = ((F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_ts"))
            & (F.col(pos) == F.col("_pos")) & (F.col("_closed") >= F.col("_et"))
            & (F.col("_closed") <= F.col("_et")
               + F.expr(f"interval {duration_ms(window)} milliseconds")))
    return rows.join(firsts, same, how)


def flag_new_visitor_stream(logs: DataFrame, key: str = "mid", ts: str = "ts",
                            pos: str = "pos", flag: str = "is_new",
                            window: str = "5 seconds", delay: str = "3 seconds") -> DataFrame:
    """`firsts.flag_new_visitor` on a stream."""
    found = first_records(logs, key, ts, pos, window, delay)
    joined = _joined(logs, found, "left_outer", key, ts, pos, window, delay)
    shown = F.when(F.col("_key").isNotNull(), "1").otherwise("0").alias(flag)
    return joined.select(*[shown if c == flag else F.col(c) for c in logs.columns],
                         *([] if flag in logs.columns else [shown]))


def daily_uv_stream(pages: DataFrame, key: str = "mid", ts: str = "ts", pos: str = "pos",
                    window: str = "5 seconds", delay: str = "5 seconds",
                    zone: str | None = None) -> DataFrame:
    """`firsts.daily_uv` on a stream."""
    found = first_records(pages, key, ts, pos, window, delay, by_day=True, zone=zone)
    return _joined(pages, found, "inner", key, ts, pos, window, delay).select(*pages.columns)


def match_next_stream(df: DataFrame, first: Column, second: Column, within: str,
                      key: str = "mid", ts: str = "ts", pos: str = "pos",
                      delay: str = "3 seconds", parts: int = PARTS) -> DataFrame:
    """`sequence.match_next` on a stream.

    A result comes out when the watermark has passed the record's bucket, a `parts`-th of the
    limit, and the limit.  Each record's time, position and two facts are in `parts` + 1
    buckets; the record itself is in one, and only if `first` holds.  Columns of `df` must
    have an order.
    """
    limit = duration_ms(within)
    width = -(-limit // parts)
    no = F.lit(False)
    marked = (df.withColumn("_first", F.coalesce(first, no))
              .withColumn("_second", F.coalesce(second, no))
              .withColumn("_et", event_time(ts)).where(F.col(key).isNotNull())
              .withWatermark("_et", delay))
    placed = marked.select("*", F.window("_et", f"{width + limit} milliseconds",
                                         f"{width} milliseconds").alias("window"))
    ends = F.unix_millis("window.start") + width
    step = F.struct(F.col(ts).alias("ts"), F.col(pos).alias("pos"),
                    (F.col("_first") & (F.col(ts) < ends)).alias("first"),
                    F.col("_second").alias("second"),
                    F.when(F.col("_first") & (F.col(ts) < ends),
                           F.struct(*df.columns)).alias("row"))
    steps = (placed.select("window", F.col(key).alias("_key"), step.alias("_step"))
             .groupBy("window", "_key")
             .agg(F.sort_array(F.collect_list("_step")).alias("_steps")))
    followed = F.zip_with("_steps", F.slice("_steps", 2, F.size("_steps")),
                          lambda one, then: F.struct(one.alias("one"), then.alias("then")))
    own = steps.select(F.explode(F.filter(followed, lambda x: x["one"]["first"])).alias("_x"))
    outcome = step_outcome(F.col("_x.then.ts") - F.col("_x.one.ts"), F.col("_x.then.second"), limit)
    return (own.withColumn("outcome", outcome).where(F.col("outcome").isNotNull())
            .select("_x.one.row.*", "outcome",
                    F.when(F.col("outcome") == MATCHED, F.col("_x.then.ts")).alias("next_ts")))


def user_jump_stream(pages: DataFrame, gap: str = "5 seconds", entry_breaks: bool = True,
                     last_page: Column | str = "last_page_id", **options) -> DataFrame:
    """`sequence.user_jump` on a stream."""
    entry = is_entry(last_page)
    out = match_next_stream(pages, entry, entry, gap, **options)
    if not entry_breaks:
        out = out.where(F.col("outcome") == TIMED_OUT)
    return out.drop("outcome", "next_ts")
