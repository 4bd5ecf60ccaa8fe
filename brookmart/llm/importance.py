"""Resampling towards a target distribution by importance weights.

Words fall into hashed buckets.  A bucket's gain is the logarithm of its share in the target
over its share in the corpus; the gains are one array of fixed size, and a document's weight
is the sum of its features' entries.  Gumbel noise from the id makes the highest scores a
sample without replacement.

The k-th best row is found by a distributed quickselect over composite keys: a few random
rows are pivots, one exact count tells how many keys lie below, on and above each, and the
rows between the two pivots around the k-th are stored for the next round.  Only the drawn
rows are sorted; they are ranked by their place in their range partition and the number of
rows in the partitions before it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, materialize, pieces, text_bytes

BUCKETS = 10_000
SMOOTHING = 10_000          # the contract adds as many to both totals as there are buckets
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
LONGEST = 1                 # words of the longest feature
PIVOTS = 16

# Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
                    for b in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


def features(data: bytes, longest: int) -> tuple[int, list[bytes]]:
    """The number of words, and all runs of one to `longest` words."""
    own = words(data)
    out = list(own)
    for n in range(2, longest + 1):
        out += map(b" ".join, zip(*(own[i:] for i in range(n))))
    return len(own), out


def bucket_numbers(found: list[bytes], buckets: int) -> np.ndarray:
    """The bucket of each feature; a repeated feature is hashed once."""
    index = {f: zlib.crc32(f) % buckets for f in set(found)}
    return np.fromiter(map(index.__getitem__, found), np.int64, len(found))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST
                  ) -> np.ndarray:
    """How often each bucket occurs in all rows: one vector a task, `buckets` numbers in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                found: list[bytes] = []
                for data in piece.column(0).to_pylist():
                    found += features(data, longest)[1]
                total += np.bincount(bucket_numbers(found, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    rows = (texts.select(text_bytes()).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray, smoothing: int = SMOOTHING) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + smoothing) / ((s + 1)(T + smoothing)))) of each bucket."""
    big, small = float(corpus.sum() + smoothing), float(target.sum() + smoothing)
    return np.array([math.floor(1000 * math.log(float(t + 1) * big / (float(s + 1) * small)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """Gumbel noise in thousandths, from the id alone; a null id counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: str = SEED
           ) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every row."""
    buckets = len(gain)

    def run(batch: pa.RecordBatch) -> dict:
        made = [features(data, longest) for data in batch.column(1).to_pylist()]
        sizes = np.array([len(f) for _, f in made], np.int64)
        values = np.r_[0, np.cumsum(gain[bucket_numbers([x for _, f in made for x in f],
                                                        buckets)])]
        ends = np.cumsum(sizes)
        weight = values[ends] - values[ends - sizes]
        extra = np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
        return {"doc_id": batch.column(0), "n_features": sizes,
                "n_words": np.array([n for n, _ in made], np.int64),
                "weight": weight, "score": weight + extra}

    return arrow_pass(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()),
                      run, "doc_id long, n_features long, n_words long, weight long, score long")


# ---- selection --------------------------------------------------------------------------

# Ascending: best rows first.
KEY = ("-score as score", "doc_id is null as no_id", "coalesce(doc_id, 0) as doc_id", "tie")


def _key() -> Column:
    return F.struct(*map(F.expr, KEY))


def _literal(key) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in
                      zip(("score", "no_id", "doc_id", "tie"), key,
                          ("long", "boolean", "long", "long"))])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest value (from 1) of the struct column `key`; None if there is none.

    `keys` is a stored table.  A round looks at what lies between the two pivots around the
    k-th key of the round before, and stores that.
    """
    rest, number = keys, 0
    while k > 0:
        drawn = sorted({tuple(r.key) for r in rest.orderBy(
            F.xxhash64("key.tie", F.lit(number)), "key").limit(pivots).collect()})
        if not drawn:
            return None
        counts = rest.agg(*[F.count(F.when(F.col("key") < _literal(p), 1)) for p in drawn],
                          *[F.count(F.when(F.col("key") == _literal(p), 1)) for p in drawn]
                          ).first()
        low, below = None, 0
        for p, less, equal in zip(drawn, counts[:len(drawn)], counts[len(drawn):]):
            if k <= less:
                rest = rest.where(F.col("key") < _literal(p))
                break
            if k <= less + equal:
                return p
            low, below = p, less + equal
        if low is not None:
            rest, k = rest.where(F.col("key") > _literal(low)), k - below
        rest, number = materialize(rest, "select"), number + 1
    return None


def ranked(winners: DataFrame) -> DataFrame:
    """`winners` with their rank by `key`: sorted by range, numbered within each range."""
    placed = materialize(winners.repartitionByRange("key").sortWithinPartitions("key")
                         .withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())   # a row for each task
    before, starts = 0, []
    for number, count in sizes:
        starts.append((number, before))
        before += count
    offsets = winners.sparkSession.createDataFrame(starts, "part long, before long")
    return placed.join(offsets, part == F.col("part")).withColumn(
        "rank", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
             seed: str = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, n_features, weight, score, rank.

    floor(percent * N / 100) of the N rows with at least `least_words` words are drawn, by
    score, then smaller doc_id (null last); `rank` numbers them and is null for the others.
    Null and empty texts have no features and weight 0.  Rows with one id and one score tie:
    each counts, and which of them has the smaller rank is free.  Other columns are ignored;
    an empty target leaves only the smoothing; an empty table gives no rows.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    own = materialize(scored(docs, gain, longest, seed)
                      .withColumn("tie", F.monotonically_increasing_id()), "scored")
    fits = F.col("n_words") >= least_words
    k = own.where(fits).count() * percent // 100
    last = kth_key(own.where(fits).select(_key().alias("key")), k)
    shown = ("doc_id", "n_features", "weight", "score")
    if last is None:
        return own.select(*shown, F.lit(None).cast("long").alias("rank"))
    drawn = fits & (_key() <= _literal(last))
    return (own.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank"))
            .unionAll(ranked(own.where(drawn).withColumn("key", _key())).select(*shown, "rank")))
