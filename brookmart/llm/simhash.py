"""Near duplicates by SimHash, found with anchor points of a covering code.

A fingerprint's 64 bits are cut into three blocks.  Of two fingerprints that differ in at
most four bits, the two blocks left after dropping the one with most differences differ in at
most two.  Each block is a word of the binary Golay code's space, whose 4,096 code words lie
within three bits of every word: they are the anchors, one for each pair of blocks and pair
of code words.  Some word lies within one bit of both fingerprints, and within the covering
radius of its anchor; so a fingerprint is sent to the anchors of all words within one bit of
it (radius plus its half of the threshold, about ten for each pair of blocks), and linked
fingerprints meet at one anchor at least.  Members of an anchor are compared there.

Small groups are compared pair by pair in numpy.  Large ones emit a spanning forest of their
links, so the output stays linear; groups over `BLOCK` members are cut into blocks, each pair
of blocks a task of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, components, materialize, row_key, text_bytes

SHINGLE = 4
SEED = 42
THRESHOLD = 4
BLOCKS = ((0, 21), (21, 21), (42, 22))      # first bit and width
GOLAY = 0b101011100011                      # generator of the (23, 12) code
BLOCK = 4_096                               # members of an anchor compared in one go
PAIRWISE = 64                               # up to here every linked pair is emitted
CHUNK = 1 << 16


def shingles(data: bytes, width: int) -> list[bytes]:
    """Space-joined shingles of the lower-cased words; a short text is one shingle."""
    words = data.lower().split()
    if not words:
        return []
    if len(words) <= width:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def simhash(features: list[bytes], seed: int = SEED) -> int:
    """Bit b is set if it is in over half of the features' XXH64; 0 without features."""
    if not features:
        return 0
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, len(features), CHUNK):
        part = features[start:start + CHUNK]
        hashes = np.fromiter((digest(f, seed) for f in part), "<u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                                ).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(features), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, make: Callable[[bytes], list[int]], keep: str,
                 schema: str) -> DataFrame:
    """`(keep, salt, fp)`: the fingerprints that `make` gives for each text, by number."""

    def run(batch: pa.RecordBatch) -> dict:
        made = [make(t) for t in batch.column(1).to_pylist()]
        count = [len(m) for m in made]
        owner = np.repeat(np.arange(len(made)), count)
        return {keep: batch.column(0).take(pa.array(owner)),
                "salt": np.array([i for m in made for i in range(len(m))], np.int32),
                "fp": np.array([f for m in made for f in m], np.uint64).view(np.int64)}

    return arrow_pass(docs.select(keep, "text"), run, f"{schema}, salt int, fp long")


# ---- anchors ----------------------------------------------------------------------------

@cache
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high and the low 12 bits, and the error that each syndrome means."""
    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    high = np.array([syndrome(w << 12) for w in range(1 << 11)], np.uint32)
    low = np.array([syndrome(w) for w in range(1 << 12)], np.uint32)
    error = np.zeros(1 << 11, np.uint32)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            error[high[word >> 12] ^ low[word & 0xFFF]] = word
    return high, low, error


def nearest(words: np.ndarray) -> np.ndarray:
    """The code word (its 12 leading bits) within three bits of each 23-bit word."""
    high, low, error = _decoder()
    return (words ^ error[high[words >> np.uint32(12)] ^ low[words & np.uint32(0xFFF)]]
            ) >> np.uint32(11)


def anchors(prints: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """`(row, anchor)`: every anchor to which each fingerprint goes, once."""
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError(f"a threshold of 0 to {THRESHOLD} bits is covered")
    homes, moved = [], []
    for first, width in BLOCKS:
        word = ((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = np.array([1 << b for b in range(width)], np.uint32)
        homes.append(nearest(word))
        moved.append(nearest(word[:, None] ^ flips[None, :]))
    rows, keys = [], []
    every = np.arange(len(prints))
    for table, (x, y) in enumerate(combinations(range(len(BLOCKS)), 2)):
        base = np.uint32(table << 24)
        home = base | homes[x] << np.uint32(12) | homes[y]
        cells = np.concatenate([home[:, None],
                                base | moved[x] << np.uint32(12) | homes[y][:, None],
                                base | homes[x][:, None] << np.uint32(12) | moved[y]], axis=1)
        cells.sort(axis=1)
        new = np.ones(cells.shape, bool)
        new[:, 1:] = cells[:, 1:] != cells[:, :-1]
        rows.append(np.broadcast_to(every[:, None], cells.shape)[new])
        keys.append(cells[new])
    return np.concatenate(rows), np.concatenate(keys)


def _replicate(batch: pa.RecordBatch) -> dict:
    """Columns id, salt, fp -> anchor, id, fp; each salt has anchors of its own."""
    prints = batch.column(2).to_numpy().view(np.uint64)
    rows, keys = anchors(prints)
    salt = batch.column(1).to_numpy()[rows].astype(np.int64)
    return {"anchor": salt << 32 | keys, "id": batch.column(0).to_numpy()[rows],
            "fp": prints[rows].view(np.int64)}


# ---- comparison -------------------------------------------------------------------------

def forest(ids: np.ndarray, prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among members, from the most central member on."""
    left = np.arange(len(ids))
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    centre = np.packbits(bits.sum(axis=0) * 2 > len(ids), bitorder="little").view(np.uint64)[0]
    left = left[np.argsort(np.bitwise_count(prints ^ centre), kind="stable")]
    a, b = [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop(0)
            near = np.bitwise_count(prints[left] ^ prints[x]) <= threshold
            reached, left = left[near], left[~near]
            a.append(np.full(len(reached), ids[x]))
            b.append(ids[reached])
            todo.extend(reached)
    none = np.zeros(0, np.int64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def compare(anchor: np.ndarray, ids: np.ndarray, prints: np.ndarray, threshold: int,
            pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal neighbouring anchors."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, n in zip(starts[sizes > pairwise], sizes[sizes > pairwise]):
        x, y = forest(ids[s:s + n], prints[s:s + n], threshold)
        a.append(x)
        b.append(y)
    end = np.repeat(starts + sizes, sizes)
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= pairwise), sizes))
    for step in range(1, pairwise):
        at = at[at + step < end[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= threshold]
        a.append(ids[near])
        b.append(ids[near + step])
    return np.concatenate(a), np.concatenate(b)


def _compare_stream(threshold: int, block: int, pairwise: int):
    """Sorted (anchor, id, fp) -> links (hot false, a, b); groups over `block` members come
    out as members (hot true, a = anchor, b = id, fp, part) instead."""
    schema = pa.schema([("hot", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()),
                        ("fp", pa.int64()), ("part", pa.int64())])

    def rows(hot, a, b, fp, part) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hot)), pa.array(a),
                                           pa.array(b), pa.array(fp), pa.array(part)],
                                          schema=schema)

    def links(anchor, ids, fp) -> pa.RecordBatch:
        a, b = compare(anchor, ids, fp.view(np.uint64), threshold, pairwise)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        zero = np.zeros(len(pairs), np.int64)
        return rows(False, pairs[:, 0].copy(), pairs[:, 1].copy(), zero, zero)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        hot, count = None, 0
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            if hot is not None:
                n = int(np.searchsorted(new[0], hot, "right"))
                yield rows(True, new[0][:n], new[1][:n], new[2][:n],
                           (count + np.arange(n)) // block)
                count += n
                new = [c[n:] for c in new]
                if not len(new[0]):
                    continue
                hot = None
            held = [np.concatenate([h, c]) for h, c in zip(held, new)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1], "left"))
            if last:
                yield links(*(h[:last] for h in held))
            held = [h[last:] for h in held]
            if len(held[0]) > block:
                hot, count = held[0][0], len(held[0])
                yield rows(True, *held, np.arange(count) // block)
                held = [np.zeros(0, np.int64)] * 3
        if len(held[0]):
            yield links(*held)

    return run


def hamming_links(prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK,
                  pairwise: int = PAIRWISE) -> DataFrame:
    """`prints(id, salt, fp)` -> distinct links `(a, b)`, a < b: ids that share a salt and
    differ in at most `threshold` bits there.  In groups over `pairwise` members at an anchor
    the links are a spanning forest, which reaches the same components.  Up to four bits all
    pairs are found; with a higher threshold those of them that meet at an anchor.
    """
    sent = arrow_pass(prints.select("id", "salt", "fp"), _replicate,
                      "anchor long, id long, fp long")
    found = materialize(
        sent.repartition("anchor").sortWithinPartitions("anchor", "id")
        .mapInArrow(_compare_stream(threshold, block, pairwise),
                    "hot boolean, a long, b long, fp long, part long"), "anchor-links")
    plain = found.where("not hot").select("a", "b")
    members = found.where("hot").select(F.col("a").alias("anchor"), F.col("b").alias("id"),
                                        "fp", "part")
    parts = members.groupBy("anchor").agg(F.max("part").alias("last"))
    paired = (members.join(parts, "anchor").withColumn("other", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("last"))))
        .select("anchor", F.least("part", "other").alias("x"),
                F.greatest("part", "other").alias("y"), "id", "fp"))

    def meet(table: pa.Table) -> pa.Table:
        a, b = forest(table["id"].to_numpy(), table["fp"].to_numpy().view(np.uint64), threshold)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    hot = paired.groupBy("anchor", "x", "y").applyInArrow(meet, "a long, b long")
    return plain.union(hot).where("a <> b").distinct()


def shingle_fingerprint(data: bytes) -> list[int]:
    return [simhash(shingles(data, SHINGLE))]


def _roots(nodes: DataFrame, threshold: int) -> DataFrame:
    """`(fp, root)` of the fingerprints (column `fp`, distinct) that have a near one."""
    if threshold > THRESHOLD:
        raise ValueError(f"only up to {THRESHOLD} bits all pairs are sure to be found")
    links = hamming_links(nodes.select(F.col("fp").alias("id"), F.lit(0).alias("salt"), "fp"),
                          threshold)
    return components(links).withColumnRenamed("node", "fp")


def near_components(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at `threshold` or fewer differing bits; component_id is the smallest
    doc_id reachable.  Null and empty texts have the fingerprint zero, linked like any other.
    A null doc_id is passed over by the minimum: component_id is null only where all ids are.
    Repeated rows come out as often as they come in; other columns are ignored; an empty
    table gives no rows.
    """
    own = materialize(fingerprints(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")),
        shingle_fingerprint, "doc_id", "doc_id long").drop("salt"), "fingerprints")
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labelled = nodes.join(_roots(nodes, threshold), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = materialize(labelled.join(least, "root").select("fp", "component_id"), "labels")
    return own.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# ---- one document of each group ---------------------------------------------------------

def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of `docs` without near copies, with all their columns.

    Rows are grouped as `near_components` groups them.  Of each group the row with the
    smallest doc_id stays (null ids last, then by the text's hash), once if it is repeated;
    which of several rows with one id and one text that is, is free.  Null and empty texts
    share the fingerprint zero and are one group.  An empty table gives no rows.
    """
    keyed = docs.select(F.struct(row_key().alias("row_key"),
                                 F.col("doc_id").cast("long").alias("doc_id")).alias("own"),
                        text_bytes().alias("text"))
    own = materialize(fingerprints(keyed, shingle_fingerprint, "own",
                                   "own struct<row_key:long,doc_id:long>")
                      .select("own.*", "fp"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    nodes = materialize(own.groupBy("fp").agg(
        F.min(order).alias("first"), F.count("*").alias("n")), "nodes")
    labelled = nodes.join(_roots(nodes, threshold), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    best = (labelled.groupBy("root")
            .agg(F.min("first").alias("stays"), F.sum("n").alias("n"))
            .where("n > 1").select("root", "stays"))
    grouped = materialize(
        labelled.join(best, "root").select("fp", "stays"), "groups")
    members = (own.join(grouped, "fp")
               .groupBy("row_key", (F.col("row_key") == F.col("stays.row_key")).alias("stays"))
               .agg(F.count("*").alias("n")))
    # Rows of groups that go, and those that stay but come more than once.
    marked = materialize(members.where("not stays or n > 1").select("row_key", "stays"), "marked")
    rows = docs.select(row_key().alias("row_key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    repeated = (rows.join(marked.where("stays").select("row_key"), "row_key", "left_semi")
                .groupBy("row_key").agg(F.first("row").alias("row")))
    return (rows.join(marked.select("row_key"), "row_key", "left_anti").select("row.*")
            .unionAll(repeated.select("row.*")))
