"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on the ordinary text plus
the passages typical of toxic documents.  Each window of a text is compressed with both;
where the toxic dictionary saves bytes, the window resembles toxic text.  How many windows
save how much, against thresholds calibrated on training documents, gives the score.

A window is one word (at most WINDOW_BYTES of it) followed by a fixed tail: zstandard looks
for no match in the last bytes of its input, and short inputs need something both
dictionaries share.  Windows repeat, so their saving is remembered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, materialize, text_bytes

TAIL = b"\x01\x02window\x03\x04zzqqxxkkvvww" * 2
WINDOW_BYTES = 64
LEVEL = 9
SAMPLE_ROWS = 8_000          # most labelled rows that the dictionaries are trained on
ORDINARY_WINDOWS = 7_000     # most windows in the ordinary dictionary
TOXIC_WINDOWS = 1_500        # most windows that the toxic dictionary has besides
LEAST_SHARE = 0.02           # a typical window is in this share of toxic documents,
LEAST_LIFT = 8               # and in so many times the share of ordinary ones
SAVINGS = (1, 2, 3, 4, 5, 6, 8)
CACHE = 1 << 18


def windows(data: bytes) -> list[bytes]:
    out = []
    for word in data.lower().split():
        if len(word) <= WINDOW_BYTES:
            out.append(word)
        else:
            out.extend(word[i:i + WINDOW_BYTES] for i in range(0, len(word), WINDOW_BYTES))
    return out


def dictionary(samples: list[bytes]) -> bytes:
    """Content of a dictionary: the samples as words, the last of them nearest."""
    return b" " + b"  ".join(samples) + b" " + TAIL


class Savings(dict):
    """Window -> bytes the toxic dictionary saves; forgets all when it grows too large."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        super().__init__()
        self.by = [zstandard.ZstdCompressor(
            level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
            dict_data=zstandard.ZstdCompressionDict(
                d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress for d in (ordinary, toxic)]

    def __missing__(self, window: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        padded = b" " + window + b" " + TAIL
        saved = self[window] = len(self.by[0](padded)) - len(self.by[1](padded))
        return saved


@lru_cache(maxsize=2)
def savings(ordinary: bytes, toxic: bytes) -> Savings:
    """One memory of savings for all tasks of a worker."""
    return Savings(ordinary, toxic)


def statistics(data: bytes, saved: Savings) -> np.ndarray:
    """What the savings of a text's windows look like."""
    found = windows(data)
    d = np.fromiter(map(saved.__getitem__, found), np.int32, len(found)) if found \
        else np.zeros(1, np.int32)
    n = len(d)
    top = np.sort(d)[:-7:-1]
    over = np.array([(d >= s).sum() for s in SAVINGS])
    return np.r_[top[0], top[:3].mean(), top.mean(), np.log1p(over), np.sqrt(over / n), d.mean(),
                 np.log(n)]


@dataclass
class Model:
    """Both dictionaries and the calibration; without dictionaries the score is `rate`."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    rate: float = 0.0

    def score(self, texts) -> np.ndarray:
        if not len(self.weights) or not len(texts):
            return np.full(len(texts), self.rate)
        saved = savings(self.ordinary, self.toxic)
        x = np.stack([statistics(t, saved) for t in texts])
        return _logistic(x, self.mean, self.scale, self.weights)


def _logistic(x, mean, scale, weights) -> np.ndarray:
    z = np.c_[(x - mean) / scale, np.ones(len(x))] @ weights
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, ...]:
    """Ridge logistic regression by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.eye(len(w))
        w = w + np.linalg.solve(curve, a.T @ (y - p) - w)
    return mean, scale, w


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training must not see: crc32 of the id's digits leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `sample_rows` labelled rows that are not held out.

    Those whose id hashes lowest are taken; rows without id or label are left out.  Windows
    are counted in Spark, over the whole texts of the sample; the driver gets the bounded
    dictionaries and one line of figures for each sampled document.
    """
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows))
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
             .join(F.broadcast(sample), "doc_id")  # at most sample_rows narrow rows
             .select("toxic", "text"))

    def split(batch: pa.RecordBatch) -> dict:
        found = [sorted(set(windows(t))) for t in batch.column(1).to_pylist()]
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return {"toxic": batch.column(0).take(pa.array(owner)),
                "win": [w for f in found for w in f]}

    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    rate = bad / max(bad + good, 1)
    none = np.zeros(0)
    if not bad or not good:
        return Model(b"", b"", none, none, none, rate)
    counted = materialize(
        arrow_pass(known, split, "toxic int, win binary").groupBy("win")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "windows")
    ordinary = [bytes(r["win"]) for r in counted.where("good > 0").orderBy(
        F.desc("good"), "win").limit(ORDINARY_WINDOWS).collect()]
    typical = counted.where((F.col("bad") >= max(3, LEAST_SHARE * bad)) & (
        F.col("bad") / bad > LEAST_LIFT * (F.col("good") + 1) / good))
    toxic = [bytes(r["win"]) for r in typical.orderBy(
        F.desc("bad"), "win").limit(TOXIC_WINDOWS).collect()]
    plain, both = dictionary(ordinary[::-1]), dictionary(ordinary[::-1] + toxic[::-1])

    def measure(batch: pa.RecordBatch) -> dict:
        saved = savings(plain, both)
        return {"toxic": batch.column(0),
                "stats": [statistics(t, saved).tolist() for t in batch.column(1).to_pylist()]}

    rows = (arrow_pass(known, measure, "toxic int, stats array<double>")
            .orderBy("toxic", "stats").limit(sample_rows).collect())
    x, y = np.array([r["stats"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    return Model(plain, both, *calibrate(x, y), rate)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    Only the text counts; null and empty texts are scored like a text with one window that
    saves nothing.  Rows with a null id are never held out.  Repeated rows come out as they
    come in; other columns are ignored; an empty table gives no rows.
    """
    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       judge(text_bytes()).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
