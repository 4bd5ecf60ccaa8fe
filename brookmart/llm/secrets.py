"""Secrets: fixed patterns, and a linear-chain conditional random field for what they miss.

The field tags tokens as begin, inside or outside of a secret.  A token's score comes from
its own length, shape and spread of characters, from the two words before and the one after
it, and from the file it stands in; tags are decoded by Viterbi.  It is trained on the fixed
patterns' matches in a bounded sample, so that look and surroundings carry over to secrets
that no pattern describes.

Nearly all tokens cannot be part of a secret.  An upper bound on the gain of every stretch of
tokens, by running sums, leaves short islands; outside of them all tags are O in the best
path, so Viterbi on the islands is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, materialize

# The base patterns, by kind in the order of ties.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hex digits matches whole or not at all
KINDS = ("assign", "access", "hex", "crf")
WORDS = ("passw", "secret", "token", "api")

TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|[:=]")
OUT, BEGIN, INSIDE = range(3)
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "auth",
            "credential", "bearer", "private", "access")
SHAPES = ("lower", "capital", "upper", "digits", "hex", "lower-digit", "upper-digit", "mixed",
          "mixed-digit", "special")
LENGTHS = (4, 8, 12, 16, 20, 24, 32, 40)
OWN = (len(LENGTHS) + 1) * len(SHAPES) * 4 + len(KEYWORDS) + 2
COARSE = 3 * len(SHAPES) + len(KEYWORDS) + 3     # the last one is "no token"
NONE = COARSE - 1
FILES = 8
SAMPLE_ROWS = 20_000        # most documents the field is trained on
SEGMENTS = 3_000            # most stretches of SEGMENT tokens taken from them
SEGMENT = 48
CACHE = 1 << 18


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Matches of the fixed patterns as `(start, kind, end)`, in order."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def value_spans(text: str) -> list[tuple[int, int]]:
    """The secrets themselves in the matches: the assigned value, not its name."""
    out = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return sorted(set(out + [m.span() for m in HEX.finditer(text)]))


# ---- features ---------------------------------------------------------------------------

def shape(token: str) -> int:
    if not token.isalnum():
        return 9
    if token.isdigit():
        return 3
    if token.isalpha():
        if token.islower():
            return 0
        if token.isupper():
            return 2
        return 1 if token[1:].islower() else 7
    if all(c in "0123456789abcdefABCDEF" for c in token):
        return 4
    return 5 if token.islower() else 6 if token.isupper() else 8


class Classes(dict):
    """Token -> own class and coarse class in one number; forgets all when too large."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        rest = (len(LENGTHS) + 1) * len(SHAPES) * 4
        low = token.lower().strip("_.-")
        if token in ":=":
            own, coarse = rest + len(KEYWORDS) + ":=".index(token), \
                3 * len(SHAPES) + len(KEYWORDS) + ":=".index(token)
        elif low in KEYWORDS:
            k = KEYWORDS.index(low)
            own, coarse = rest + k, 3 * len(SHAPES) + k
        else:
            s = shape(token)
            size = sum(len(token) >= n for n in LENGTHS)
            spread = min(3, 4 * len(set(token)) // max(len(token), 1))
            own = (size * len(SHAPES) + s) * 4 + spread
            coarse = 3 * s + (0 if size < 2 else 1 if size < 4 else 2)
        value = self[token] = own * 1000 + coarse
        return value


def file_class(text: str, tokens: int) -> int:
    """What kind of file it is: how much of it is punctuation of code, and its size."""
    code = sum(map(text.count, "={}();"))
    return (tokens > 200) + 2 * ((code > 0) + (code * 200 > len(text)) + (code * 20 > len(text)))


def columns(found: list[str], classes: Classes, file: int) -> np.ndarray:
    """Feature numbers of each token: own, before, two before, after, file."""
    both = np.fromiter(map(classes.__getitem__, found), np.int64, len(found))
    own, coarse = both // 1000, both % 1000
    padded = np.r_[NONE, NONE, coarse, NONE]
    n = len(found)
    return np.stack([own, OWN + padded[1:n + 1], OWN + COARSE + padded[:n],
                     OWN + 2 * COARSE + padded[3:n + 3],
                     np.full(n, OWN + 3 * COARSE + file)], axis=1)


FEATURES = OWN + 3 * COARSE + FILES


# ---- the field --------------------------------------------------------------------------

@dataclass
class Field:
    """Weights of begin and inside relative to outside, and of tag pairs."""

    weights: np.ndarray      # FEATURES x 3, the column of OUT is zero
    pairs: np.ndarray        # 3 x 3, from and to

    def emissions(self, cols: np.ndarray) -> np.ndarray:
        return self.weights[cols].sum(axis=1)

    def tags(self, cols: np.ndarray) -> dict[int, int]:
        """Tokens of the best path that are not outside, with their tags."""
        if not len(cols):
            return {}
        e = self.emissions(cols)
        most = max(self.pairs[a, b] for a in range(3) for b in range(3) if a or b)
        gain = np.maximum(e[:, BEGIN], e[:, INSIDE]) + most
        total = np.r_[0.0, np.cumsum(gain)]
        left = total[1:] - np.minimum.accumulate(total[:-1])
        right = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
        possible = np.flatnonzero(left + right - gain > -max(most, 0.0) - 1e-9)
        found: dict[int, int] = {}
        if len(possible):
            cuts = np.flatnonzero(np.diff(possible) > 1) + 1
            for island in np.split(possible, cuts):
                best = self.viterbi(e[island])
                found.update((int(i), t) for i, t in zip(island, best) if t)
        return found

    def viterbi(self, e: np.ndarray) -> list[int]:
        """Best tags of a stretch with outside on both sides."""
        score = self.pairs[OUT] + e[0]
        back = []
        for row in e[1:]:
            step = score[:, None] + self.pairs
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + row
        last = int((score + self.pairs[:, OUT]).argmax())
        path = [last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


FORBIDDEN = -1e4


def fit(cols: np.ndarray, tags: np.ndarray, epochs: int = 80, rate: float = 0.2,
        decay: float = 1e-3) -> Field:
    """Conditional maximum likelihood over segments `cols[n, SEGMENT, 5]`, `tags[n, SEGMENT]`
    (-1 after a segment's end), by Adam on forward-backward gradients.

    Without any secret the field finds none.
    """
    weights, pairs = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    pairs[OUT, INSIDE] = FORBIDDEN
    if not len(cols) or not (tags > 0).any():
        weights[:, 1:] = FORBIDDEN
        return Field(weights, pairs)
    n, length = tags.shape
    there = tags >= 0
    hot = np.eye(3)[np.maximum(tags, 0)] * there[..., None]
    seen_pairs = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
    flat = cols.reshape(-1, cols.shape[2])
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((3, 3)), np.zeros((3, 3))]
    for t in range(1, epochs + 1):
        e = weights[cols].sum(axis=2)
        e = np.where(there[..., None], e, 0.0)
        move = np.where(there[:, 1:, None, None], pairs, np.where(np.eye(3) > 0, 0.0, FORBIDDEN))
        ahead, behind = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        ahead[:, 0] = e[:, 0] + np.array([0.0, 0.0, FORBIDDEN])
        for i in range(1, length):
            ahead[:, i] = e[:, i] + _lse(ahead[:, i - 1, :, None] + move[:, i - 1], 1)
        for i in range(length - 2, -1, -1):
            behind[:, i] = _lse(move[:, i] + (e[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
        norm = _lse(ahead[:, -1], 1)
        p = np.exp(ahead + behind - norm[:, None, None]) * there[..., None]
        both = np.exp(ahead[:, :-1, :, None] + move + (e + behind)[:, 1:, None, :]
                      - norm[:, None, None, None]) * there[:, 1:, None, None]
        error = (hot - p).reshape(-1, 3)
        g_w = np.zeros_like(weights)
        for k in range(flat.shape[1]):
            for tag in (BEGIN, INSIDE):
                g_w[:, tag] += np.bincount(flat[:, k], error[:, tag], minlength=FEATURES)
        g_p = seen_pairs - both.sum(axis=(0, 1))
        g_p[OUT, OUT] = g_p[OUT, INSIDE] = 0.0
        for value, g, m, v in ((weights, g_w / n - decay * weights, *moments[:2]),
                               (pairs, g_p / n - decay * pairs * (pairs > FORBIDDEN / 2),
                                *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Field(weights, pairs)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def segments(text: str, classes: Classes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches of a text's tokens with tags taken from the fixed patterns."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    cols = columns([text[a:b] for a, b in spans], classes, file_class(text, len(spans)))
    starts = np.array([a for a, _ in spans], np.int64)
    tags = np.zeros(len(spans), np.int64)
    for a, b in value_spans(text):
        i, j = np.searchsorted(starts, a), np.searchsorted(starts, b)
        if i < j and tags[i] == OUT:
            tags[i] = BEGIN
            tags[i + 1:j] = np.where(tags[i + 1:j] == OUT, INSIDE, tags[i + 1:j])
    for i in range(0, len(spans), SEGMENT):
        yield cols[i:i + SEGMENT], tags[i:i + SEGMENT]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, most: int = SEGMENTS) -> Field:
    """Fit on at most `most` segments of the `sample_rows` documents whose id hashes lowest.

    At most half of them hold a secret; those that hash lowest are taken.  Rows without id or
    text are left out.
    """
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"))
              .where(F.col("doc_id").isNotNull())
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).distinct())
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .where(F.col("text").isNotNull())
             .join(F.broadcast(sample), "doc_id", "left_semi").select("text"))  # narrow, bounded

    def cut(batch: pa.RecordBatch) -> dict:
        classes, cols, tags = Classes(), [], []
        for text in batch.column(0).to_pylist():
            for c, t in segments(text, classes):
                cols.append(c.astype(np.int16).tobytes())
                tags.append(t.astype(np.int8).tobytes())
        return {"cols": cols, "tags": tags, "secret": [any(t) for t in tags]}

    made = materialize(arrow_pass(texts, cut, "cols binary, tags binary, secret boolean")
                       .dropDuplicates(["cols", "tags"]), "segments")
    rows = [r for secret in (True, False) for r in made.where(F.col("secret") == secret)
            .orderBy(F.xxhash64("cols"), "cols", "tags").limit(most // 2).collect()]
    cols = np.zeros((len(rows), SEGMENT, 5), np.int64)
    tags = np.full((len(rows), SEGMENT), -1, np.int64)
    for k, r in enumerate(rows):
        t = np.frombuffer(r["tags"], np.int8)
        tags[k, :len(t)] = t
        cols[k, :len(t)] = np.frombuffer(r["cols"], np.int16).reshape(-1, 5)
    return fit(cols, tags)


def found_spans(text: str, field: Field, classes: Classes) -> list[tuple[int, int]]:
    """Secrets that the field finds, as character spans."""
    found = TOKEN.findall(text)
    tags = field.tags(columns(found, classes, file_class(text, len(found))))
    if not tags:
        return []
    spans = [m.span() for m in TOKEN.finditer(text)]
    out: list[tuple[int, int]] = []
    for i in sorted(tags):
        if tags[i] == INSIDE and out and i - 1 in tags:
            out[-1] = (out[-1][0], spans[i][1])
        else:
            out.append(spans[i])
    return out


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are `kind:start:end` in code points, by start and then kind.  Those of the field
    (`crf`) are added where they touch no base span; base spans all stay.  Null counts as
    empty.  Repeated rows and null ids come out as they come in; other columns are ignored;
    an empty table gives no rows.
    """
    def run(texts: pd.Series) -> pd.DataFrame:
        classes, out = Classes(), []
        for text in texts:
            base = base_spans(text)
            count = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            more = [(a, 3, b) for a, b in found_spans(text, field, classes)
                    if all(b <= x or y <= a for x, _, y in base)]
            out.append((*count, hashlib.sha256(_join(base).encode()).hexdigest(),
                        _join(sorted(base + more))))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    judge = F.pandas_udf(
        run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        judge(F.coalesce("text", F.lit(""))).alias("found"))
            .select("doc_id", "found.*"))
