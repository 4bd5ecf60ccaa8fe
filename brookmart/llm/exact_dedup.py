"""Exact duplicates by counting quotient filters.

Every partition of fingerprints becomes a counting quotient filter: the high bits of a
fingerprint (quotient) choose a bucket, the low bits (remainder) are kept sorted in it with
their counts.  Filters of one bucket from all partitions are merged by their sorted
remainders without loss.  A fingerprint counted once belongs to a text of its own and is
done; the others go to byte verification, which groups whole texts.

A hot text costs one filter entry a partition and one grouped row a partition, however many
copies it has.  Only ids, digests and filters are shuffled for texts that occur once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import LOWER, UPPER, arrow_pass, ints, materialize

QUOTIENT_BITS = 12
FINGERPRINT_BITS = 64


def build_filter(fingerprints: np.ndarray, quotient_bits: int, bits: int
                 ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """`(quotient, sorted remainders, counts)` of each bucket that holds something."""
    values, counts = np.unique(fingerprints, return_counts=True)
    rest = np.uint64(bits - quotient_bits)
    quotients = values >> rest
    remainders = values & ((np.uint64(1) << rest) - np.uint64(1))
    starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]]) if len(values) else []
    for lo, hi in zip(starts, [*starts[1:], len(values)]):
        yield int(quotients[lo]), remainders[lo:hi], counts[lo:hi].astype(np.int64)


def merge_buckets(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted `(remainders, counts)` of one bucket; equal remainders add up."""
    remainders = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(remainders, kind="stable")
    remainders, counts = remainders[order], counts[order]
    first = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
    return remainders[first], np.add.reduceat(counts, first)


def repeated_fingerprints(prints: DataFrame, quotient_bits: int = QUOTIENT_BITS,
                          bits: int = FINGERPRINT_BITS) -> DataFrame:
    """`(fp, n)` of the fingerprints (long column `fp`) that occur more than once."""
    mask = np.uint64((1 << bits) - 1)
    rest = bits - quotient_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One filter for each batch bounds the memory; merging makes up for the split.
        for batch in batches:
            rows = list(build_filter(ints(batch.column(0)).view(np.uint64) & mask,
                                     quotient_bits, bits))
            yield pa.RecordBatch.from_pydict(
                {"quotient": [r[0] for r in rows], "remainders": [r[1].tobytes() for r in rows],
                 "counts": [r[2].tobytes() for r in rows]},
                schema=pa.schema([("quotient", pa.int32()), ("remainders", pa.binary()),
                                  ("counts", pa.binary())]))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        remainders, counts = merge_buckets(
            [(np.frombuffer(r, np.uint64), np.frombuffer(c, np.int64))
             for r, c in zip(table["remainders"].to_pylist(), table["counts"].to_pylist())])
        many = counts > 1
        full = (np.uint64(key[0].as_py()) << np.uint64(rest)) | remainders[many]
        return pa.table({"fp": pa.array(full.view(np.int64)), "n": pa.array(counts[many])})

    return (prints.select("fp").mapInArrow(build, "quotient int, remainders binary, counts binary")
            .groupBy("quotient").applyInArrow(merge, "fp long, n long"))


def _digests(batch: pa.RecordBatch) -> dict:
    return {"doc_id": batch.column(0), "fp": batch.column(1),
            "text_sha256": [hashlib.sha256(t.lower()).hexdigest()
                            for t in batch.column(2).to_pylist()]}


def fingerprint(bits: int = FINGERPRINT_BITS):
    """Equal normalised texts have equal fingerprints; byte verification sorts out the rest."""
    value = F.xxhash64(F.lower(F.coalesce(F.col("text"), F.lit(""))))
    return value if bits == 64 else value.bitwiseAND((1 << bits) - 1)


def exact_dedup(docs: DataFrame, fingerprint_bits: int = FINGERPRINT_BITS,
                quotient_bits: int | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty.  The
    largest doc_id of a group stays.  Rows that share both text and doc_id tie: all are
    `kept`, and `keep_first` leaves one of them.  A null doc_id is kept only where its whole
    group has none.  Other columns of `docs` are ignored; an empty table gives no rows.

    `quotient_bits` is the number of merge buckets; by default it grows with the row count
    so that a bucket stays near a hundred thousand fingerprints.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    digests = materialize(arrow_pass(
        source.select("doc_id", fingerprint(fingerprint_bits).alias("fp"),
                      F.coalesce("text", F.lit("")).cast("binary").alias("text")),
        _digests, "doc_id long, fp long, text_sha256 string"), "digests")
    if quotient_bits is None:
        quotient_bits = max(8, min(30, (digests.count() // 100_000).bit_length()))
    quotient_bits = min(quotient_bits, fingerprint_bits - 1)
    suspects = materialize(
        repeated_fingerprints(digests, quotient_bits, fingerprint_bits), "suspects")
    groups = materialize(_verify(source, suspects, fingerprint_bits), "groups")
    return (digests.drop("fp").join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256"))


def _verify(source: DataFrame, suspects: DataFrame, bits: int) -> DataFrame:
    """Byte verification: texts whose fingerprint repeats, grouped by all their bytes."""
    return (source.withColumn("fp", fingerprint(bits))
            .join(suspects.select("fp"), "fp", "left_semi")
            .groupBy(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("norm"))
            .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .where("group_size > 1")
            .select(F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                    "keep_id", "group_size"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, one for each text, with their own columns.

    The row with the largest doc_id of each text stays; among full copies of a row the
    choice is free.  Texts that occur once are not shuffled when the repeated fingerprints
    are few; they are never grouped.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         fingerprint().alias("fp"))
    suspects = materialize(repeated_fingerprints(source), "suspects").select("fp")
    single = source.join(suspects, "fp", "left_anti")
    staying = (source.join(suspects, "fp", "left_semi")
               .groupBy(F.translate(F.coalesce("row.text", F.lit("")), UPPER, LOWER).alias("norm"))
               .agg(F.max_by("row", F.struct(F.col("row.doc_id").isNotNull(),
                                             F.col("row.doc_id").cast("long"))).alias("row")))
    return single.select("row.*").unionAll(staying.select("row.*"))
