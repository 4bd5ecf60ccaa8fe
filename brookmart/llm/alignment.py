"""Alignment of two tokenizers over every text.

Both encode the text with a space before it; token bytes give each token its byte range.  A
batch of documents is merged in lockstep: a state vector holds, for every document, the place
of its current token under either tokenizer.  A step emits the pair of current tokens as a
link, emits a cut where both end at one byte, and moves on the token that ends first, or
both; documents that are through leave the vector.  A long document enters it as several
lanes of `LANE` bytes: a lane starts at the tokens that reach past its first byte and owns the
links whose common bytes end in it, so lanes give each link once.

Neither tokenizer merges across a space that stands between two characters other than white
space, so texts are cut there and a distinct piece is encoded once for many batches.

Each document keeps its distinct id pairs with their numbers of links.  How many documents
hold a pair is counted over the corpus.  Pairs above a frequency that at most `HOT_PAIRS`
reach are looked up in a sorted array; the others are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, count_threshold, materialize, text_bytes
from brookmart.llm.lexicon import SPACE, VOCABULARY, Encoder, Ragged, Vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LANE = 1_024                # bytes of a document that one place of the state vector covers
MEMORY = 1 << 18            # distinct pieces that a worker remembers
HOT_PAIRS = 1 << 20         # pairs whose counts are sent to every task, 13 bytes each
PIECE = 2 << 20             # bytes of a batch that are aligned together
HELD_PAIRS = 1 << 20        # distinct pairs that a task counts before it passes them on

_CUT = re.compile(rb"(?<! ) (?!" + SPACE + rb"|\Z)")
_ODD = re.compile(rb"  | (?:" + SPACE + rb"|\Z)")


def parts_of(data: bytes) -> list[bytes]:
    """The parts of a space and a text, each without the space before it."""
    if data[:1] != b" " and not _ODD.search(data):
        return data.split(b" ")
    parts = _CUT.split(b" " + data)
    return parts[1:] if not parts[0] else [parts[0][1:], *parts[1:]]


class Pieces:
    """A sentencepiece model with the bytes of its pieces."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece!r} reaches across a space")
            tokens.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i)
                          else piece.replace("▁", " ").encode())
        self.tokens = Ragged.of(tokens, np.uint8)

    def encode(self, parts: list[bytes]) -> Ragged:
        return Ragged.of(self.model.encode([p.decode() for p in parts], num_threads=1), np.int32)


class TwoEncoders:
    """Encodes texts by both tokenizers; remembers the parts of texts."""

    def __init__(self, vocabulary: bytes, model: bytes):
        self.a, self.b = Vocabulary(vocabulary), Pieces(model)
        self.encoder = Encoder(self.a, special=False)
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        none = np.zeros(0, np.int64)
        self.tables = [Ragged(np.zeros(0, np.int32), none), Ragged(np.zeros(0, np.int32), none)]
        self.whole = np.zeros(0, bool)      # the bytes of both encodings are the part's own

    def _learn(self, parts: list[bytes]) -> None:
        made = [self.encoder.words([b" " + p for p in parts]), self.b.encode(parts)]
        whole = np.ones(len(parts), bool)
        for ids, tokens in zip(made, (self.a.tokens, self.b.tokens)):
            own = tokens.take(ids.flat).merged(ids.sizes)
            data, ends = own.flat.tobytes(), np.cumsum(own.sizes).tolist()
            whole &= [data[s:e] == b" " + p for s, e, p in zip(own.starts.tolist(), ends, parts)]
        self.index.update(zip(parts, range(len(self.index), len(self.index) + len(parts))))
        self.tables = [Ragged(np.concatenate([old.flat, new.flat]),
                              np.concatenate([old.sizes, new.sizes]))
                       for old, new in zip(self.tables, made)]
        self.whole = np.concatenate([self.whole, whole])

    def texts(self, texts: list[bytes]) -> tuple[Ragged, Ragged]:
        """The ids of each text under either; none where a text is empty or not kept whole."""
        cut = [parts_of(t) if t else [] for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [p for c in cut for p in c]
        distinct = set(flat)
        new = [p for p in distinct if p not in self.index]
        if len(self.index) + len(new) > MEMORY and self.index:
            self.clear()
            new = list(distinct)
        if new:
            self._learn(new)
        number = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), counts)
        broken = np.bincount(owner[~self.whole[number]], minlength=len(texts)) > 0
        number, counts = number[~broken[owner]], np.where(broken, 0, counts)
        a, b = (t.take(number).merged(counts) for t in self.tables)
        return a, b


@lru_cache(maxsize=1)
def encoders(vocabulary: bytes, model: bytes) -> TwoEncoders:
    return TwoEncoders(vocabulary, model)


# ---- merging ----------------------------------------------------------------------------

def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, document_ends: np.ndarray, lane: int = LANE
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links `(a, b)` and cuts `(a, b)` as token places, over documents laid end to end.

    Token ends are byte offsets into the whole batch; each document's end is one of both.
    """
    begins = np.r_[0, document_ends[:-1]]
    count = -(-(document_ends - begins) // lane)
    owner = np.repeat(np.arange(len(begins)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = begins[owner] + number * lane
    stop = np.minimum(first + lane, document_ends[owner])
    a, b = np.searchsorted(ends_a, first, "right"), np.searchsorted(ends_b, first, "right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        end = np.minimum(end_a, end_b)
        own = end <= stop
        if not own.all():
            a, b, end_a, end_b, end, stop = (x[own] for x in (a, b, end_a, end_b, end, stop))
        links_a.append(a)
        links_b.append(b)
        same = end_a == end_b
        cuts_a.append(a[same])
        cuts_b.append(b[same])
        going = end < stop
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x or [none]) for x in (links_a, links_b, cuts_a, cuts_b))


def group_texts(a: Ragged, b: Ragged, cuts_a: np.ndarray, cuts_b: np.ndarray,
                decimals: Ragged) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each document: its groups of ids between cuts."""
    cuts_a, cuts_b = np.sort(cuts_a), np.sort(cuts_b)
    n_a, n_b = len(a.flat), len(b.flat)
    group_a = np.searchsorted(cuts_a, np.arange(n_a))
    group_b = np.searchsorted(cuts_b, np.arange(n_b))
    # An A token stands behind the B tokens of earlier groups, a B token behind the A tokens
    # of its own group too.
    at_a = np.arange(n_a) + np.r_[0, cuts_b + 1][group_a]
    at_b = np.arange(n_b) + (cuts_a + 1)[group_b]
    ids = np.empty(n_a + n_b, np.int32)
    ids[at_a], ids[at_b] = a.flat, b.flat
    made = decimals.take(ids)
    after = np.cumsum(made.sizes) - 1
    made.flat[after[at_a[cuts_a]]] = ord("|")
    made.flat[after[at_b[cuts_b]]] = ord(";")
    documents = made.merged(a.sizes + b.sizes)
    data = made.flat.tobytes()
    return [data[s:s + max(n - 1, 0)]
            for s, n in zip(documents.starts.tolist(), documents.sizes.tolist())]


def align(texts: list[bytes], two: TwoEncoders, lane: int = LANE) -> dict:
    """Columns of one batch: counts, group texts, and each document's distinct id pairs."""
    a, b = two.texts(texts)
    sizes_a, sizes_b = two.a.tokens.sizes[a.flat], two.b.tokens.sizes[b.flat]
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    stops = np.r_[0, ends_a][np.cumsum(a.sizes)]
    link_a, link_b, cuts_a, cuts_b = lockstep(ends_a, ends_b, stops, lane)
    owner = np.repeat(np.arange(len(texts)), a.sizes)
    wide = len(two.a.tokens.sizes) * len(two.b.tokens.sizes)
    pair = a.flat[link_a].astype(np.int64) * len(two.b.tokens.sizes) + b.flat[link_b]
    held, times = np.unique(owner[link_a] * wide + pair, return_counts=True)
    of, pairs = held // wide, held % wide
    n = len(texts)
    counts = np.bincount(of, minlength=n)
    at = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return {"n_a": a.sizes, "n_b": b.sizes,
            "n_groups": np.bincount(owner[cuts_a], minlength=n),
            "n_links": np.bincount(owner[link_a], minlength=n),
            "groups": group_texts(a, b, cuts_a, cuts_b, two.a.decimals),
            "pairs": pa.ListArray.from_arrays(at, pa.array(pairs)),
            "times": pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32)))}


# ---- the corpus -------------------------------------------------------------------------

def pair_counts(own: DataFrame, pieces_b: int) -> DataFrame:
    """`(pair, n, best)`: in how many documents a pair is linked, and whether no pair of the
    same A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            both, back = np.unique(np.concatenate([held, new]), return_inverse=True)
            count = np.bincount(back, np.concatenate([count, n]), len(both)).astype(np.int64)
            held = both
            if len(held) >= HELD_PAIRS:
                yield pa.RecordBatch.from_pydict({"pair": held, "n": count})
                held, count = held[:0], count[:0]
        yield pa.RecordBatch.from_pydict({"pair": held, "n": count})

    counted = materialize(own.select("pairs").mapInArrow(run, "pair long, n long")
                          .groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    a = F.floor(F.col("pair") / pieces_b)
    most = counted.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return materialize(counted.join(most, a == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def summed(own: DataFrame, counts: DataFrame, most: int = HOT_PAIRS) -> DataFrame:
    """`own` without its pairs, with n_best and count_sum."""
    least = count_threshold(counts, most)
    kept = [c for c in own.columns if c not in ("pairs", "times")]
    hot = counts.where(F.col("n") >= least).toArrow()       # about `most` narrow rows
    order = np.argsort(hot["pair"].to_numpy())
    shared = own.sparkSession.sparkContext.broadcast(
        (hot["pair"].to_numpy()[order], hot["n"].to_numpy()[order],
         hot["best"].to_numpy()[order]))

    def look_up(batch: pa.RecordBatch):
        """Pairs and times, whether they are hot, their places if so, and their rows."""
        known = shared.value[0]
        pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        is_hot = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        sizes = np.diff(batch.column("pairs").offsets.to_numpy())
        return pairs, times, is_hot, at, np.repeat(np.arange(batch.num_rows), sizes)

    def sums(batch: pa.RecordBatch) -> dict:
        _, times, is_hot, at, row = look_up(batch)
        _, n, best = shared.value
        row, at, times = row[is_hot], at[is_hot], times[is_hot].astype(np.int64)
        return {**{c: batch.column(c) for c in kept},
                "hot_sum": _added(row, times * n[at], batch.num_rows),
                "hot_best": _added(row, times * best[at], batch.num_rows)}

    def others(batch: pa.RecordBatch) -> dict:
        pairs, times, is_hot, _, row = look_up(batch)
        return {"row": batch.column("row").to_numpy()[row[~is_hot]], "pair": pairs[~is_hot],
                "times": times[~is_hot]}

    schema = ", ".join(f"{n} {t}" for n, t in own.select(*kept).dtypes)
    base = arrow_pass(own, sums, f"{schema}, hot_sum long, hot_best long")
    cold = (arrow_pass(own.select("row", "pairs", "times"), others,
                       "row long, pair long, times int")
            .join(counts.where(F.col("n") < least), "pair").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("n")).alias("cold_sum"),
                 F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("cold_best")))
    zero = F.lit(0).cast("long")
    return base.join(cold, "row", "left").select(
        *kept, (F.col("hot_best") + F.coalesce("cold_best", zero)).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("cold_sum", zero)).alias("count_sum"))


def _added(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Integer sums of `values` by row; rows come in order."""
    upto = np.r_[0, np.cumsum(values, dtype=np.int64)]
    edges = np.searchsorted(row, np.arange(rows + 1))
    return upto[edges[1:]] - upto[edges[:-1]]


def aligned(docs: DataFrame, vocabulary_file: str = VOCABULARY, model_file: str = MODEL,
            texts: bool = True, lane: int = LANE, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, groups, n_best,
    count_sum; with `texts` false groups_sha256 in the place of groups.

    A pair's count is the number of rows that hold it linked.  Null and empty texts, and those
    whose tokens do not spell a space and the text, have no tokens: zeros and an empty
    `groups`, which is not hashed.  Names of special tokens in a text are plain text.  Repeated
    rows count each and come out as they come in, null ids too; other columns are ignored; an
    empty table gives no rows.

    The driver reads both vocabulary files, whose sizes are fixed, and the counts of at most
    `hot_pairs` pairs.
    """
    with open(vocabulary_file, "rb") as one, open(model_file, "rb") as two:
        content = docs.sparkSession.sparkContext.broadcast((one.read(), two.read()))
    shown = "groups string" if texts else "groups_sha256 string"

    def run(batch: pa.RecordBatch) -> dict:
        made = align(batch.column(1).to_pylist(), encoders(*content.value), lane)
        groups = made.pop("groups")
        if texts:
            made["groups"] = [g.decode() for g in groups]
        else:
            made["groups_sha256"] = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
        return {"doc_id": batch.column(0), **made}

    own = materialize(arrow_pass(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()), run,
        f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {shown}, "
        "pairs array<long>, times array<int>", PIECE)
        .withColumn("row", F.monotonically_increasing_id()), "alignment")
    pieces_b = Pieces(content.value[1]).model.get_piece_size()
    return summed(own, pair_counts(own, pieces_b), hot_pairs).drop("row")
