"""Ordinal quality grades by cumulative-link regression over hashed text.

All grades share one weight vector over hashed byte trigrams and a few form features
(repetition, length); ordered thresholds turn the score into cumulative probabilities

    P(grade >= k) = sigmoid(score - threshold[k]),   threshold[1] < threshold[2] < ...

from which come the expected grade and the tail probability that selects documents.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, text_bytes

HASH_BITS = 16
FORMS = 1 << 12                 # slots after the trigrams for form features
TRIGRAM_SCALE = 30.0
FORM_SCALE = 3.0
SAMPLE_ROWS = 3_000             # most labelled rows the regression is fitted on
EPOCHS = 120
KEEP_SHARE = 0.3                # a document goes when its tail probability is below this
CHUNK = 1 << 20


def trigrams(data: bytes):
    """Hashes of the text's byte trigrams, in chunks that bound the memory."""
    for start in range(0, max(len(data) - 2, 0), CHUNK):
        b = np.frombuffer(data, np.uint8, min(CHUNK + 2, len(data) - start), start
                          ).astype(np.uint32)
        yield ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16))
               * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)


def forms(data: bytes) -> list[int]:
    """Slots of the form features: tenths of several shares, with the text's length."""
    words = data.split()
    lines = data.split(b"\n")
    n = max(len(words), 1)
    size = min(15, len(words).bit_length())
    shares = (sum(map(operator.eq, words, words[1:])) / n, len(set(words)) / n,
              len(set(lines)) / len(lines), len(data) / n / 20)
    base = 1 << HASH_BITS
    return [base + size] + [base + 16 + 256 * i + 16 * (size if i == 1 else 0)
                            + min(15, int(10 * x)) for i, x in enumerate(shares)]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one text: slots and values."""
    counts = np.zeros(1 << HASH_BITS, np.int64)
    for h in trigrams(data):
        counts += np.bincount(h, minlength=len(counts))
    slots = np.flatnonzero(counts)
    values = counts[slots] * (TRIGRAM_SCALE / max(counts.sum(), 1))
    own = forms(data)
    return (np.r_[slots, own].astype(np.int32),
            np.r_[values, np.full(len(own), FORM_SCALE)].astype(np.float32))


@dataclass
class Ordinal:
    """Shared weights and the ordered thresholds of grades 1, 2, ..."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, data: bytes) -> float:
        total, n = 0.0, 0
        for h in trigrams(data):
            total += float(self.weights[h].sum(dtype=np.float64))
            n += len(h)
        return (TRIGRAM_SCALE * total / max(n, 1)
                + FORM_SCALE * float(self.weights[forms(data)].sum()))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: one row a score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, top: int,
        epochs: int = EPOCHS, decay: float = 1e-3) -> Ordinal:
    """Maximum likelihood by full-batch Adam; the same rows always give the same model.

    Without rows every document is certain to have the top grade.
    """
    size = (1 << HASH_BITS) + FORMS
    if not rows:
        return Ordinal(np.zeros(size, np.float32), np.full(top, -50.0))
    slots = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, slots = np.unique(slots, return_inverse=True)
    # steps: log gaps between neighbouring thresholds keep them in order
    params = [np.zeros(len(used)), np.zeros(1), np.zeros(max(top - 1, 0))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n = len(rows)
    for t in range(1, epochs + 1):
        w, first, gaps = params
        thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
        score = np.bincount(owner, values * w[slots], minlength=n)
        p = 1 / (1 + np.exp(np.clip(thresholds - score[:, None], -50, 50)))
        # P(grade = k) is a difference of neighbouring tails; d log-likelihood / d tail
        tail = np.c_[np.ones(n), p, np.zeros(n)]
        own = np.maximum(tail[np.arange(n), grades] - tail[np.arange(n), grades + 1], 1e-9)
        slope = p * (1 - p)
        pull = ((grades[:, None] == np.arange(1, top + 1)).astype(float)
                - (grades[:, None] == np.arange(top)).astype(float)) * slope / own[:, None]
        by_threshold = -pull.sum(axis=0) / n
        g_w = np.bincount(slots, values * pull.sum(axis=1)[owner], minlength=len(used)) / n
        g_gaps = np.array([by_threshold[k + 1:].sum() for k in range(top - 1)]) * np.exp(gaps)
        grads = [-(g_w - decay * w), -by_threshold.sum(keepdims=True), -g_gaps]
        for i, g in enumerate(grads):
            m, v = moments[i]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[i] = params[i] - 0.1 * (m / (1 - 0.9 ** t)) / (
                np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = params[0]
    return Ordinal(weights, params[1] + np.r_[0.0, np.cumsum(np.exp(params[2]))])


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Graded rating from the two labels: 0 poor, 1 good but toxic, 2 good."""
    return (F.when(F.col(quality) == 0, 0).when(F.col(toxic) == 1, 1)
            .when(F.col(quality) == 1, 2))


def train(docs: DataFrame, ratings: DataFrame, top: int = 2,
          sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """Fit on at most `sample_rows` rated documents, those whose id hashes lowest.

    `ratings(doc_id, grade)` has grades 0 to `top`; null ids, null grades and others are
    left out.  Only the sample's features reach the driver.
    """
    sample = (ratings.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.col("grade").cast("int").alias("grade"))
              .where(F.col("doc_id").isNotNull() & F.col("grade").between(0, top))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows))

    def extract(batch: pa.RecordBatch) -> dict:
        both = [features(t) for t in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "grade": batch.column(1),
                "slots": [s.tobytes() for s, _ in both], "vals": [v.tobytes() for _, v in both]}

    rated = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
             .join(F.broadcast(sample), "doc_id")  # at most sample_rows narrow rows
             .select("doc_id", "grade", "text"))
    got = (arrow_pass(rated, extract, "doc_id long, grade int, slots binary, vals binary")
           .orderBy("doc_id", "grade", F.xxhash64("slots")).limit(sample_rows).collect())
    rows = [(np.frombuffer(r["slots"], np.int32), np.frombuffer(r["vals"], np.float32))
            for r in got]
    return fit(rows, np.array([r["grade"] for r in got], np.int64), top)


def _judge(model: Ordinal, minimum: int, share: float) -> Column:
    @F.pandas_udf("expected_grade double, tail_probability double, selected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        tails = model.tails(np.array([model.score(t) for t in texts], np.float64))
        own = tails[:, minimum - 1]
        return pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail_probability": own,
                             "selected": own >= share})

    return judge(text_bytes())


def score(docs: DataFrame, model: Ordinal, minimum: int = 1, share: float = KEEP_SHARE
          ) -> DataFrame:
    """One row per row of `docs`: doc_id, expected_grade, tail_probability, selected.

    A row is selected if P(grade >= minimum) >= share.  Null texts count as empty; empty ones
    are scored by their form.  Repeated rows and null ids come out as they come in; other
    columns are ignored; an empty table gives no rows.
    """
    return docs.select("doc_id", _judge(model, minimum, share).alias("judged")).select(
        "doc_id", "judged.*")


def select_good(docs: DataFrame, model: Ordinal, minimum: int = 1, share: float = KEEP_SHARE
                ) -> DataFrame:
    """The rows of `docs` that `score` would select, with all their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _judge(model, minimum, share).alias("judged"))
    return rows.where("judged.selected").select("row.*")
