"""Balanced shards by longest-processing-time scheduling.

Groups that must stay together are dealt, largest first, each to the least-loaded shard,
which a heap yields.  To deal billions of groups without passing them through one place,
groups of nearly the same size (their 10 leading bits agree) form a class, large classes
are cut by hash into runs of bounded length, and the heap deals whole rounds of a run: the
driver sees one line a run, never a group.  A group's place in its run then tells its shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import materialize

RUN_GROUPS = 100_000
SLOT_ROWS = 100_000
LEADING_BITS = 10


def _level(loads: list[float], amount: float) -> float:
    """The level that `amount` reaches when it fills up the lowest loads first."""
    low = sorted(loads)
    below = 0.0
    for n, load in enumerate(low, start=1):
        below += load
        level = (below + amount) / n
        if n == len(low) or level <= low[n]:
            return level
    return amount


def deal(runs: list[tuple[int, int, float]], shards: int) -> dict[int, list[int]]:
    """Longest-processing-time over runs `(run, groups, mean size)`.

    Returns each run's number of groups for every shard.  Whole rounds that level the loads
    are dealt at once, what is left one by one through the heap.
    """
    loads = [0.0] * shards
    quotas = {}
    for run, groups, size in sorted(runs, key=lambda r: (-r[2], r[0])):
        quota = [0] * shards
        if groups > 4 * shards and size > 0:
            level = _level(loads, groups * size)
            quota = [max(0, int((level - load) / size) - 1) for load in loads]
            loads = [load + q * size for load, q in zip(loads, quota)]
        heap = [(loads[s], s) for s in range(shards)]
        heapq.heapify(heap)
        for _ in range(groups - sum(quota)):
            load, s = heapq.heappop(heap)
            quota[s] += 1
            heapq.heappush(heap, (load + size, s))
        for load, s in heap:
            loads[s] = load
        quotas[run] = quota
    return quotas


def shard(docs: DataFrame, shards: int = 24, run_groups: int = RUN_GROUPS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 8; null texts have none and group with empty ones.
    Equal texts stay together.  The law is `bytes`: loads differ by little more than the
    largest group.  Slots count a shard's rows from 0 without gaps.  Repeated rows and null
    ids get slots of their own; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")), "shard-rows")
    low_bits = f"(cast(floor(log2(total)) as int) - {LEADING_BITS})"
    groups = rows.groupBy("key").agg(F.sum("size").alias("total")).withColumn("class", F.expr(
        f"if({low_bits} <= 0, total, shiftleft(shiftright(total, {low_bits}), {low_bits}))"))
    groups = materialize(groups, "shard-groups")
    # A line for each class, so that its number of parts is joined and not written into the plan.
    parts = materialize(groups.groupBy("class").agg(
        F.ceil(F.count("*") / F.lit(run_groups)).alias("parts")), "shard-classes")
    groups = groups.join(parts, "class").withColumn(
        "part", F.pmod(F.xxhash64("key"), F.col("parts"))).drop("parts")
    spark = docs.sparkSession
    lines = [(i, r) for i, r in enumerate(
        groups.groupBy("class", "part").agg(F.count("*").alias("n"), F.sum("total").alias("bytes"))
        .orderBy("class", "part").collect())]
    quotas = deal([(i, r["n"], r["bytes"] / r["n"]) for i, r in lines], shards)
    plan = []
    for i, r in lines:
        end, ends = 0, []
        for q in quotas[i]:
            end += q
            ends.append(end)
        plan.append((r["class"], r["part"], ends))
    dealt = spark.createDataFrame(plan, "class long, part long, ends array<long>")
    # In hash order, so that no shard always gets the smaller groups of a class.
    place = F.row_number().over(Window.partitionBy("class", "part")
                                .orderBy(F.xxhash64("key"), "key"))
    placed = (groups.withColumn("place", place).join(dealt, ["class", "part"])
              .select("key", F.size(F.filter("ends", lambda e: e < F.col("place")))
                      .cast("int").alias("shard")))
    rows = rows.join(placed, "key").drop("key")
    return _slots(rows, shards)


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    """Number each shard's rows: places inside small buckets plus the buckets' offsets."""
    spark = rows.sparkSession
    # Copies of a whole row are told apart by where they stand, so they are no hot bucket.
    rows = materialize(rows.withColumn("spread", F.xxhash64(
        "doc_id", "text_crc32", "size", F.monotonically_increasing_id())), "shard-dealt")
    buckets = max(8, rows.count() // (SLOT_ROWS * shards))
    rows = rows.withColumn("bucket", F.pmod("spread", F.lit(buckets)))
    offsets = [(r["shard"], r["bucket"], r["count"]) for r in
               rows.groupBy("shard", "bucket").count().orderBy("shard", "bucket").collect()]
    table, last, total = [], None, 0
    for s, b, n in offsets:
        total = total if s == last else 0
        table.append((s, b, total))
        last, total = s, total + n
    offset = spark.createDataFrame(table, "shard int, bucket long, offset long")
    place = F.row_number().over(Window.partitionBy("shard", "bucket")
                                .orderBy("spread", F.col("doc_id"), "text_crc32"))
    return rows.withColumn("place", place).join(offset, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
