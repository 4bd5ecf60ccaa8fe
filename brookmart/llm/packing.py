"""Best-fit packing into sequences of several permitted lengths.

Pieces go, longest first, into the open sequence they fill best.  Where none fits, a new
sequence is opened at the size whose cost for each token it can still get is least; whole
plans that never open below each permitted size are tried as well, and the cheapest plan
wins.  Last, every sequence shrinks to the smallest permitted length that holds its contents.

Rows are dealt by hash to groups of about `GROUP_PIECES`, packed independently: only a
group's last sequences are less than full.  No key decides the group, so none can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import materialize

CAPACITIES = (512, 1024, 2048, 4096)
GROUP_PIECES = 20_000
SEQUENCE_COST = 16          # what a sequence costs besides its tokens
ATTENTION_COST = 1 / 65_536  # what each pair of positions costs, in tokens


def cost(capacity: int) -> float:
    return capacity + SEQUENCE_COST + ATTENTION_COST * capacity * capacity


def best_fit(lengths: Sequence[int], capacities: Sequence[int], least: int = 0,
             price: Callable[[int], float] = cost) -> tuple[list[int], list[int], list[int]]:
    """`(sequence of each piece, its offset, capacity of each sequence)` of one plan.

    `lengths` must fall and none may exceed the largest capacity.  With `least`, sequences
    are opened at that size or the next that holds the piece.
    """
    open_by_rest: dict[int, list[int]] = {}
    rests = 0  # bit r is set while an open sequence has r positions left
    sequence, offset, size, used = [], [], [], []
    left = sum(lengths)
    for n in lengths:
        fits = rests >> n
        if fits:
            rest = n + (fits & -fits).bit_length() - 1
            s = open_by_rest[rest].pop()
            if not open_by_rest[rest]:
                rests ^= 1 << rest
        else:
            room = [c for c in capacities if c >= n]
            if least:
                c = next((c for c in room if c >= least), room[-1])
            else:
                c = min(room, key=lambda c: (price(c) / min(c, left), -c))
            s, rest = len(size), c
            size.append(c)
            used.append(0)
        sequence.append(s)
        offset.append(used[s])
        used[s] += n
        left -= n
        if rest > n:
            open_by_rest.setdefault(rest - n, []).append(s)
            rests |= 1 << (rest - n)
    return sequence, offset, [next(c for c in capacities if c >= u) for u in used]


def cheapest(lengths: Sequence[int], capacities: Sequence[int],
             price: Callable[[int], float] = cost) -> tuple[list[int], list[int], list[int]]:
    """The plan of least total cost among the adaptive one and one for each opening size."""
    plans = [best_fit(lengths, capacities, least, price) for least in (0, *capacities)]
    return min(plans, key=lambda plan: sum(map(price, plan[2])))


def words(column: str = "text") -> Column:
    """Number of words of the text; null has none."""
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")),
                          F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(docs: DataFrame, length: Column | None = None,
         capacities: Sequence[int] = CAPACITIES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, sequence, capacity, offset.

    `length` is a document's number of tokens, by default its words plus one separator, so
    an empty or null text still takes one position; a null or negative length counts as 0
    and gives one piece of length 0.  A document longer than the largest capacity is cut: its
    full pieces fill sequences of their own and the last one is packed.  Repeated rows are
    packed once each; other columns are ignored; an empty table gives no rows.
    """
    capacities = sorted(capacities)
    top = capacities[-1]
    length = words() + 1 if length is None else length
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("total")), "lengths")
    # The table is stored, so a repeated task numbers its rows the same way again.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    full = F.greatest(F.ceil(F.col("total") / top) - 1, F.lit(0)).cast("long")
    filled = (rows.where(full > 0)
              .select("doc_id", "row", F.explode(F.sequence(F.lit(0).cast("long"), full - 1))
                      .alias("piece"))
              .select("doc_id", F.col("piece").cast("int").alias("piece"),
                      (F.col("piece") * top).alias("start"), F.lit(top).alias("length"),
                      F.concat_ws("-", F.lit("f"), "row", "piece").alias("sequence"),
                      F.lit(top).alias("capacity"), F.lit(0).alias("offset")))
    groups = max(1, -(-rows.count() // group_pieces))
    rest = rows.select(
        "doc_id", "row", full.cast("int").alias("piece"), (full * top).alias("start"),
        (F.col("total") - full * top).cast("int").alias("length"),
        F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"))

    def plan(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        order = np.lexsort((table["row"].to_numpy(), -lengths))
        sequence, offset, sizes = cheapest(lengths[order].tolist(), capacities)
        table = table.take(pa.array(order))
        name = f"p-{key[0].as_py()}-"
        return pa.table({
            "doc_id": table["doc_id"], "piece": table["piece"], "start": table["start"],
            "length": table["length"], "sequence": [name + str(s) for s in sequence],
            "capacity": pa.array([sizes[s] for s in sequence], pa.int32()),
            "offset": pa.array(offset, pa.int32())})

    packed = rest.groupBy("group").applyInArrow(
        plan, "doc_id long, piece int, start long, length int, sequence string, capacity int, "
              "offset int")
    return filled.unionByName(packed)
