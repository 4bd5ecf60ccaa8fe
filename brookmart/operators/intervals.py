"""Join of two event streams on a key and a bounded distance in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.functions.times import duration_ms


def _bucket(ms: Column, width: int) -> Column:
    return F.floor(ms / width)


def interval_join(left: DataFrame, right: DataFrame, keys: tuple[str, str],
                  times: tuple[str, str], lower: str, upper: str) -> DataFrame:
    """Pairs with equal keys and right time in [left time - lower, left time + upper].

    Both ends belong to the interval; times are timestamps; column names of the two sides
    must differ.  Works on batch frames, and on streams whose times carry watermarks.

    Time is cut into buckets as wide as the interval and the bucket is part of the join
    key: a left row goes into the one or two buckets its interval touches, a right row
    into its own.  Each pair meets in exactly one bucket, and a key with many rows on both
    sides is neither handled by one task nor compared all against all.
    """
    (lk, rk), (lt, rt) = keys, times
    before, after = duration_ms(lower), duration_ms(upper)
    width = max(before + after, 1)
    at = F.unix_millis(lt)
    touched = F.sequence(_bucket(at - before, width), _bucket(at + after, width))
    spread = left.withColumn("_lb", F.explode(touched))
    placed = right.withColumn("_rb", _bucket(F.unix_millis(rt), width))
    within = F.expr(f"{rt} >= {lt} - interval {before} milliseconds"
                    f" and {rt} <= {lt} + interval {after} milliseconds")
    on = (F.col(lk) == F.col(rk)) & (F.col("_lb") == F.col("_rb")) & within
    # Both sides are facts: the small size of their files is no reason to broadcast one.
    return spread.hint("merge").join(placed, on).drop("_lb", "_rb")
