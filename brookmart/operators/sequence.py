"""Two-step sequences of one key's records, and bounced visits as a case of them.

Only the record that follows directly matters, and only if it comes within a limit.
So records are grouped by key *and* time bucket, at least as wide as the limit, and
each bucket is lent the first record of the next one.  The answer is the same as that of
one window over the whole key, but a busy key is worked on by as many tasks as it has
buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.functions.records import is_blank
from brookmart.functions.times import duration_ms

MATCHED = "matched"
TIMED_OUT = "timed_out"
# Narrower buckets split a busy key further; wider ones lend fewer records.
BUCKET = "10 minutes"


def step_outcome(gap_ms: Column, second_holds: Column, within_ms: int) -> Column:
    """Outcome of a first step, given its follower: null when the follower breaks it.

    A follower exactly at the limit is too late.
    """
    return (F.when(gap_ms.isNull() | (gap_ms >= within_ms), TIMED_OUT)
             .when(second_holds, MATCHED))


def next_records(df: DataFrame, key: str, ts: str, tie: Sequence[str], carry: Sequence[str],
                 within: str, bucket: str = BUCKET) -> DataFrame:
    """Add struct `_next` (time, tie, carry) of the key's next record.

    It may be null when that record is `within` or more away.  Times are epoch ms.
    """
    width = max(duration_ms(within), duration_ms(bucket))
    rows = df.withColumn("_bucket", F.floor(F.col(ts) / width))
    seen = [ts, *tie, *carry]
    heads = (rows.groupBy(key, "_bucket").agg(F.min(F.struct(*seen)).alias("_head"))
                 .select(key, (F.col("_bucket") - 1).alias("_bucket"), "_head.*",
                         F.lit(True).alias("_lent")))
    together = (rows.withColumn("_lent", F.lit(False))
                    .unionByName(heads, allowMissingColumns=True))
    order = Window.partitionBy(key, "_bucket").orderBy(ts, *tie)
    return (together.withColumn("_next", F.lead(F.struct(*seen)).over(order))
                    .where(~F.col("_lent")).drop("_lent", "_bucket"))


def match_next(df: DataFrame, first: Column, second: Column, within: str,
               key: str = "mid", ts: str = "ts", tie: Sequence[str] = ("pos",),
               bucket: str = BUCKET) -> DataFrame:
    """Records where `first` holds and the sequence has an `outcome`.

    `matched`: the next record satisfies `second` in time.  `timed_out`: no next record
    in time.  First steps broken by another record are dropped.  `next_ts` is the time of
    the follower of a match.
    """
    marked = df.withColumn("_first", first).withColumn("_second", second)
    followed = next_records(marked, key, ts, tie, ["_second"], within, bucket)
    gap = F.col(f"_next.{ts}") - F.col(ts)
    return (followed.where("_first")
                    .withColumn("outcome", step_outcome(
                        gap, F.col("_next._second"), duration_ms(within)))
                    .where(F.col("outcome").isNotNull())
                    .withColumn("next_ts", F.when(F.col("outcome") == MATCHED,
                                                  F.col(f"_next.{ts}")))
                    .drop("_first", "_second", "_next"))


def followed_by(df: DataFrame, first: Column, second: Column, within: str,
                **options) -> tuple[DataFrame, DataFrame]:
    """(matched, timed_out)."""
    out = match_next(df, first, second, within, **options)
    return (out.where(F.col("outcome") == MATCHED),
            out.where(F.col("outcome") == TIMED_OUT))


def is_entry(last_page: Column | str = "last_page_id") -> Column:
    """A page nobody came from inside the shop."""
    return is_blank(last_page)


def user_jump(pages: DataFrame, gap: str = "5 seconds", entry_breaks: bool = True,
              last_page: Column | str = "last_page_id", **options) -> DataFrame:
    """Entry pages that were the whole visit.

    The next page is another entry, or comes `gap` or more later, or never comes.
    With `entry_breaks=False` an entry soon followed by an entry does not count.
    """
    entry = is_entry(last_page)
    out = match_next(pages, entry, entry, gap, **options)
    if not entry_breaks:
        out = out.where(F.col("outcome") == TIMED_OUT)
    return out.drop("outcome", "next_ts")
