"""Byte-level BPE through a lexicon: a minimal acyclic transducer of frequent words.

A word is what stands between spaces, with the space before it: cutting a text before each
space that has no white space after it never cuts through a pretoken, so words can be encoded
on their own.  The words that are most frequent in the whole corpus are compiled into an
automaton whose common suffixes are shared.  Its arcs carry numbers that add up, along a
word, to the word's place among all words, and at that place are its ids.  The automaton is
one file that Spark gives to the executors and that their workers map into memory.

A batch looks up its distinct words together, one byte of all of them a step.  Words that the
lexicon lacks are cut into pretokens; these are looked up too, and what is still unseen is
merged by the vocabulary's ranks, so the lexicon decides how fast texts are encoded and never
to what.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkContext, SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass, count_threshold, materialize, pieces, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
LEXICON_WORDS = 1 << 17     # most frequent words that are compiled
LONGEST_WORD = 48           # bytes; longer words are never compiled, but merged
FLUSH = 1 << 18             # distinct words that a task counts before it passes them on

# Fixed value: how the public byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space of that pattern in UTF-8.
SPACE = (rb"(?:[\t-\r ]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
          rb"|\xe2\x81\x9f|\xe3\x80\x80)")
_CUT = re.compile(rb" (?!" + SPACE + rb"|\Z)")
_ODD = re.compile(rb" (?:" + SPACE + rb"|\Z)")
_PRETOKENS = regex.compile(PATTERN)
NONE = np.iinfo(np.int32).max
WIDTHS = (4, 8, 16, 32, 64)


def words_of(data: bytes) -> list[bytes]:
    """The words of a text; all but the first lack the space before them."""
    return _CUT.split(data) if _ODD.search(data) else data.split(b" ")


def _spans(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The concatenated ranges [start, start + size)."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


class Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.r_[0, np.cumsum(sizes)][:-1].astype(np.int64)

    @classmethod
    def of(cls, rows: list, dtype) -> Ragged:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = (np.frombuffer(b"".join(rows), np.uint8) if dtype is np.uint8 else
                np.fromiter((x for r in rows for x in r), dtype, int(sizes.sum())))
        return cls(flat, sizes)

    def take(self, index: np.ndarray) -> Ragged:
        sizes = self.sizes[index]
        return Ragged(self.flat[_spans(sizes, self.starts[index])], sizes)

    def merged(self, groups: np.ndarray) -> Ragged:
        """Neighbouring rows joined: `groups` has the number of rows of each new one."""
        ends = np.r_[0, np.cumsum(groups)]
        upto = np.r_[0, np.cumsum(self.sizes)]
        return Ragged(self.flat, upto[ends[1:]] - upto[ends[:-1]])


class Places:
    """Place of each key in an array of distinct keys of 0 and more, by open addressing."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, cells: np.ndarray, numbers: np.ndarray):
        self.cells, self.numbers = cells, numbers
        self.shift = np.uint64(64 - (len(cells).bit_length() - 1))

    @classmethod
    def of(cls, keys: np.ndarray) -> Places:
        size = 1 << max(4, (4 * len(keys)).bit_length())
        made = cls(np.full(size, -1, np.int64), np.zeros(size, np.int32))
        left, cell = np.arange(len(keys)), made._cell(keys)
        while len(left):
            free = made.cells[cell] < 0
            made.cells[cell[free]] = keys[left[free]]       # one of those that meet stays
            put = made.cells[cell] == keys[left]
            made.numbers[cell[put]] = left[put]
            left, cell = left[~put], (cell[~put] + 1) & (size - 1)
        return made

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self.FACTOR >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 for keys that are not there."""
        cell = self._cell(keys)
        held = self.cells[cell]
        found = np.where(held == keys, self.numbers[cell], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            cell[left] = (cell[left] + 1) & (len(self.cells) - 1)
            held = self.cells[cell[left]]
            same = held == keys[left]
            found[left[same]] = self.numbers[cell[left[same]]]
            left = left[~same & (held >= 0)]
        return found


# ---- vocabulary -------------------------------------------------------------------------

class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE vocabulary file."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        model = file["model"]
        # The printable stand-ins of bytes: those that print stand for themselves, the others
        # follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ids = model["vocab"]
        top = max([*ids.values(), *(t["id"] for t in file["added_tokens"])])
        tokens = [b""] * (top + 1)
        for token, i in ids.items():
            tokens[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"].encode(): t["id"] for t in file["added_tokens"]}
        for content, i in self.special.items():
            tokens[i] = content
        self.tokens = Ragged.of(tokens, np.uint8)
        self.decimals = Ragged.of([b"%d," % i for i in range(len(tokens))], np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in byte_of.items():
            self.byte_ids[b] = ids[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.pair_places, self.pair_ids = Places.of(key), np.r_[made, np.int32(-1)]
        self.by_pair = {k: (r, m) for r, (k, m) in enumerate(zip(key.tolist(), made.tolist()))}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NONE if it never merges), and the merged id."""
        real = (left >= 0) & (right >= 0)
        key = np.where(real, left.astype(np.int64) << 32 | right, 0)
        rank = np.where(real, self.pair_places.find(key.ravel()).reshape(key.shape), -1)
        return np.where(rank < 0, NONE, rank), self.pair_ids[rank]

    # -- merging --

    def merge_long(self, data: bytes) -> list[int]:
        """Merges of one pretoken, lowest rank and leftmost first, by a heap over links."""
        ids = self.byte_ids[np.frombuffer(data, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (hit := self.by_pair.get(ids[i] << 32 | ids[j])):
                heapq.heappush(heap, (hit[0], i, ids[i], ids[j], hit[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [i for i in ids if i >= 0]

    def merge(self, pretokens: list[bytes]) -> Ragged:
        """The ids of each pretoken; all pretokens of like length merge in lockstep."""
        sizes = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        out: list = [None] * len(pretokens)
        least = 0
        for width in WIDTHS:
            rows = np.flatnonzero((sizes > least) & (sizes <= width))
            least = width
            if len(rows):
                self._lockstep([pretokens[i] for i in rows], sizes[rows], width, rows, out)
        for i in np.flatnonzero((sizes > WIDTHS[-1]) | (sizes == 0)):
            out[i] = self.merge_long(pretokens[i])
        return Ragged.of(out, np.int32)

    def _lockstep(self, pretokens, sizes, width, rows, out) -> None:
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pretokens), np.uint8)
        ids = self.byte_ids[data.reshape(-1, width)]
        ids[np.arange(width)[None, :] >= sizes[:, None]] = -1
        rank, made = self.ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while True:
            at = rank.argmin(axis=1)
            every = np.arange(len(rows))
            open_ = rank[every, at] != NONE
            for row, own in zip(rows[~open_].tolist(), ids[~open_]):
                out[row] = own[own >= 0].tolist()
            if not open_.any():
                return
            rows, ids, rank, made, at = rows[open_], ids[open_], rank[open_], made[open_], at[open_]
            every = np.arange(len(rows))
            ids[every, at] = made[every, at]
            # What stands behind the merged pair moves up by one.
            moved = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, moved, axis=1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, moved[:, :-1].clip(max=width - 2), axis=1)
            made = np.take_along_axis(made, moved[:, :-1].clip(max=width - 2), axis=1)
            rank[:, -1] = NONE
            for near in (at - 1, at):
                ok = np.flatnonzero((near >= 0) & (near < width - 1))
                left = near[ok]
                rank[ok, left], made[ok, left] = self.ranks(ids[ok, left], ids[ok, left + 1])


@lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


# ---- transducer -------------------------------------------------------------------------

def compile_words(entries: list[tuple[bytes, list[int]]]) -> dict[str, np.ndarray]:
    """The minimal automaton of sorted distinct words, as arrays.

    States with the same finality and the same arcs are one state; words are added in order,
    and what can no longer change is looked up in the register of states.  An arc's output is
    the number of words that come before those behind it, so outputs add up to a word's place.
    """
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []       # of registered states: (final, ((byte, target), ...))
    counts: list[int] = []          # words accepted from each state
    path: list[list] = [[False, []]]    # states of the last word that are still open

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        state = register.get(key)
        if state is None:
            state = register[key] = len(arcs_of)
            arcs_of.append(key)
            counts.append(node[0] + sum(counts[t] for _, t in node[1]))
        return state

    last = b""
    for word, _ in entries:
        shared = len(os.path.commonprefix((last, word)))
        while len(path) > shared + 1:
            state = close(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        for _ in range(len(word) - shared):
            path.append([False, []])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        state = close(path.pop())
        path[-1][1].append((last[len(path) - 1], state))
    start = close(path[0])
    keys, targets, outputs = [], [], []
    for state, (final, arcs) in enumerate(arcs_of):
        before = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(before)
            before += counts[target]
    ids = Ragged.of([i for _, i in entries], np.int32)
    places = Places.of(np.array(keys, np.int64))
    return {"cells": places.cells, "numbers": places.numbers, "targets": np.array(targets, np.int32),
            "outputs": np.array(outputs, np.int32),
            "final": np.array([f for f, _ in arcs_of], np.uint8),
            "start": np.array([start], np.int32), "ids": ids.flat.astype(np.int32),
            "sizes": ids.sizes.astype(np.int32)}


def save(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a line that names the arrays, then their bytes, aligned to eight."""
    head = json.dumps([(k, v.dtype.str, len(v)) for k, v in arrays.items()]).encode()
    with open(path, "wb") as file:
        file.write(head + b"\n")
        for v in arrays.values():
            file.write(b"\0" * (-file.tell() % 8))
            file.write(v.tobytes())


class Transducer:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            head = file.readline()
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, arrays = len(head), {}
        for name, kind, n in json.loads(head):
            at += -at % 8
            arrays[name] = np.frombuffer(data, kind, n, at)
            at += arrays[name].nbytes
        self.arcs = Places(arrays["cells"], arrays["numbers"])
        self.targets, self.outputs = arrays["targets"], arrays["outputs"]
        self.final, self.start = arrays["final"], int(arrays["start"][0])
        self.ids = Ragged(arrays["ids"], arrays["sizes"].astype(np.int64))

    def places(self, words: Ragged) -> np.ndarray:
        """The place of each word in the lexicon, -1 if it is not there."""
        found = np.full(len(words.sizes), -1, np.int64)
        rows = np.flatnonzero(words.sizes > 0)
        state = np.full(len(rows), self.start, np.int64)
        total = np.zeros(len(rows), np.int64)
        step = 0
        while len(rows):
            at = self.arcs.find(state << 8 | words.flat[words.starts[rows] + step])
            go = at >= 0
            rows, at, total = rows[go], at[go], total[go]
            state, total, step = self.targets[at].astype(np.int64), total + self.outputs[at], step + 1
            ends = words.sizes[rows] == step
            done = ends & (self.final[state] > 0)
            found[rows[done]] = total[done]
            rows, state, total = rows[~ends], state[~ends], total[~ends]
        return found


@lru_cache(maxsize=2)
def transducer(name: str) -> Transducer:
    return Transducer(SparkFiles.get(name))


# ---- encoding ---------------------------------------------------------------------------

class Encoder:
    """Encodes texts by a vocabulary and, where one is given, a lexicon."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None = None,
                 special: bool = True):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        names = sorted(vocabulary.special, key=len, reverse=True) if special else []
        self.special = re.compile(b"(" + b"|".join(map(re.escape, names)) + b")") if names else None

    def _looked_up(self, words: list[bytes], rest) -> Ragged:
        """The ids of each word; `rest` gives those of the words not in the lexicon."""
        if self.lexicon is None:
            return rest(words)
        place = self.lexicon.places(Ragged.of(words, np.uint8))
        unseen = np.flatnonzero(place < 0)
        known = self.lexicon.ids.take(place[place >= 0])
        made = rest([words[i] for i in unseen])
        order = np.empty(len(words), np.int64)
        order[place >= 0] = np.arange(len(known.sizes))
        order[unseen] = len(known.sizes) + np.arange(len(unseen))
        return Ragged(np.concatenate([known.flat, made.flat]),
                      np.concatenate([known.sizes, made.sizes])).take(order)

    def _cut(self, words: list[bytes]) -> Ragged:
        """Ids of words by their pretokens."""
        cut = [_PRETOKENS.findall(w.decode()) for w in words]
        index = {p: i for i, p in enumerate({p for c in cut for p in c})}
        ids = self._looked_up([p.encode() for p in index], self.vocabulary.merge)
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter((index[p] for c in cut for p in c), np.int64, int(counts.sum()))
        return ids.take(flat).merged(counts)

    def words(self, words: list[bytes]) -> Ragged:
        """The ids of distinct words."""
        return self._looked_up(words, self._cut)

    def texts(self, texts: list[bytes]) -> Ragged:
        """The ids of each text.  Names of special tokens become these, if wanted."""
        flat: list[bytes] = []      # words without the space before them
        heads: list[int] = []       # places in `flat` of words that have no space before them
        fixed: dict[int, int] = {}  # places in `flat` of special tokens
        counts = np.zeros(len(texts), np.int64)
        for row, data in enumerate(texts):
            before = len(flat)
            parts = (self.special.split(data) if self.special and self.special.search(data)
                     else [data])
            for part in parts:
                if self.special and part in self.vocabulary.special:
                    fixed[len(flat)] = self.vocabulary.special[part]
                    flat.append(b"")
                elif part:
                    own = words_of(part)
                    if own[0]:
                        heads.append(len(flat))
                        flat += own
                    else:
                        flat += own[1:]
            counts[row] = len(flat) - before
        first = [flat[i] for i in heads]
        inner = {w: i for i, w in enumerate(set(flat))}
        outer = {w: len(inner) + i for i, w in enumerate(set(first))}
        special = {i: len(inner) + len(outer) + k for k, i in enumerate(set(fixed.values()))}
        number = np.fromiter(map(inner.__getitem__, flat), np.int64, len(flat))
        number[heads] = [outer[w] for w in first]
        number[list(fixed)] = [special[i] for i in fixed.values()]
        made = self.words([b" " + w for w in inner] + list(outer))
        table = Ragged(np.concatenate([made.flat, np.array(list(special), np.int32)]),
                       np.concatenate([made.sizes, np.ones(len(special), np.int64)]))
        return table.take(number).merged(counts)

    def decode(self, ids: Ragged) -> list[bytes]:
        """The text of each row of ids, in UTF-8; bytes that are none become U+FFFD."""
        made = self.vocabulary.tokens.take(ids.flat).merged(ids.sizes)
        data = made.flat.tobytes()
        return [data[s:s + n].decode("utf-8", "replace").encode()
                for s, n in zip(made.starts.tolist(), made.sizes.tolist())]

    def decimals(self, ids: Ragged) -> list[bytes]:
        """Each row's ids as decimals joined by commas."""
        made = self.vocabulary.decimals.take(ids.flat).merged(ids.sizes)
        data = made.flat.tobytes()
        return [data[s:s + max(n - 1, 0)]
                for s, n in zip(made.starts.tolist(), made.sizes.tolist())]


# ---- the corpus -------------------------------------------------------------------------

def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS, longest: int = LONGEST_WORD
                   ) -> list[bytes]:
    """The most frequent words of all texts, each with the space before it, sorted.

    They are those that reach the least count that at most `most` words reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for piece in pieces(batch):
                for data in piece.column(0).to_pylist():
                    seen.update(words_of(data)[1:])
                if len(seen) >= FLUSH:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    def rows(seen: Counter) -> pa.RecordBatch:
        fit = [(w, n) for w, n in seen.items() if len(w) < longest]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in fit], pa.binary()), pa.array([n for _, n in fit], pa.int64())],
            names=["word", "n"])

    counted = materialize(docs.select(text_bytes()).mapInArrow(run, "word binary, n long")
                          .groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counted.where(F.col("n") >= count_threshold(counted, most)).select("word").toArrow()
    return sorted(b" " + w for w in top["word"].to_pylist())     # `most` short words


def compile_lexicon(words: Iterable[bytes], content: bytes, context: SparkContext) -> str:
    """Compile the words into a file that every executor gets; its name for `transducer`."""
    words = sorted(set(words))
    ids = Encoder(vocabulary(content)).words(words)
    entries = [(w, ids.flat[s:s + n].tolist())
               for w, s, n in zip(words, ids.starts.tolist(), ids.sizes.tolist())]
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="brookmart-lexicon-"), name)
    save(compile_words(entries), path)
    context.addFile(path)
    return name


def encode(docs: DataFrame, vocabulary_file: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS,
           special: bool = True) -> DataFrame:
    """One row per row of `docs`: doc_id, ids array, decoded string.

    See `digests` for what awkward rows give.
    """
    def columns(encoder: Encoder, ids: Ragged) -> dict:
        return {"ids": pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(ids.sizes)].astype(np.int32)), pa.array(ids.flat)),
                "decoded": [t.decode() for t in encoder.decode(ids)]}

    return _encoded(docs, vocabulary_file, lexicon_words, special, columns,
                    "ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary_file: str = VOCABULARY,
            lexicon_words: int = LEXICON_WORDS, special: bool = True) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, ids_sha256, decoded_sha256.

    `special`: names of special tokens in a text become these tokens.  Null and empty texts
    have no tokens and decode to the empty text.  Repeated rows and null ids come out as they
    come in; other columns are ignored; an empty table gives no rows.

    The driver reads the vocabulary file, whose size is fixed, and holds the `lexicon_words`
    most frequent words, each of less than `LONGEST_WORD` bytes.
    """
    def columns(encoder: Encoder, ids: Ragged) -> dict:
        return {"n_tokens": ids.sizes,
                "ids_sha256": [hashlib.sha256(t).hexdigest() for t in encoder.decimals(ids)],
                "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in encoder.decode(ids)]}

    return _encoded(docs, vocabulary_file, lexicon_words, special, columns,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs, vocabulary_file, lexicon_words, special, columns, schema) -> DataFrame:
    context = docs.sparkSession.sparkContext
    with open(vocabulary_file, "rb") as file:
        content = file.read()
    name = compile_lexicon(frequent_words(docs, lexicon_words), content, context)
    shared = context.broadcast(content)

    def run(batch: pa.RecordBatch) -> dict:
        encoder = Encoder(vocabulary(shared.value), transducer(name), special)
        return {"doc_id": batch.column(0), **columns(
            encoder, encoder.texts(batch.column(1).to_pylist()))}

    return arrow_pass(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()),
                      run, f"doc_id long, {schema}")
