"""Benchmark decontamination by template windows.

Texts become templates: numbers, units and names turn into typed placeholders, other words
into lower case.  Windows of a document's template are hash-joined to those of the benchmark
items.  A window counts only if its slots are consistent: equal values in the item are equal
in the document and different ones differ, in the window and over the whole alignment of
document and item.  So a question with other numbers or names is caught, and a text that only
has the same shape is not.

Which words are names is not certain, so each text has three templates (`FORMS`), and a
finding under one of them is enough: names are the capitalised words inside sentences; or
none, which bears copies in other cases and with other line breaks; or all capitalised words,
which bears other names at the start of sentences.

Before the join a bitmap of fixed size, made from the benchmark's window hashes, sorts out
nearly all document windows inside the pass that reads the text; the join itself settles the
rest, so a full bitmap costs time and never a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import materialize, pieces, row_key

WINDOW = 8          # template tokens in a window
SHORTEST = 4        # items with fewer tokens are too common to look for with other values
MIN_WINDOWS = 3     # windows of an item that must be found, or all it has
BITMAP_BITS = 23    # the filter takes 2**BITMAP_BITS bits, whatever the benchmark's size
SLICE_BITS = 16
CACHE = 1 << 19
HITS = 20_000       # most hits held before they are sent on

# Unit words that follow numbers.
UNITS = frozenset("""
    mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs ms ns hz khz mhz ghz
    v kv w kw mw kwh j kj cal kcal pa kpa n kn k c f usd eur gbp cent cents dollar dollars
    euro euros pound pounds percent meter meters metre metres kilometer kilometers kilometre
    kilometres mile miles inch inches foot feet yard yards gram grams kilogram kilograms
    liter liters litre litres second seconds minute minutes hour hours day days week weeks
    month months year years degree degrees
""".split())

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?]")
LITERAL, NUMBER, UNIT, CAPITAL, END = range(5)
FORMS = INSIDE, NO_NAMES, ANYWHERE = range(3)   # which capitalised words are names
BASE = 0x9E3779B97F4A7C15
SCHEMA = "form int, pos int, width int, hash long, pattern string, slots array<string>"


def classify(token: str, low: str) -> int:
    """A token's kind, as far as it tells by itself; `low` is its lower-case word."""
    if low in UNITS:
        return UNIT
    first = token[0]
    if token == low:
        return END if first in ".!?" else NUMBER if first.isdigit() else LITERAL
    return CAPITAL if len(token) > 1 and first.isupper() and token[1:].islower() else LITERAL


class Chunks(dict):
    """What stands between white space -> its number; the tokens of a chunk are kept by number.

    Chunks repeat, so each is cut into tokens once and documents are gathers from the arrays.
    """

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.words: list[str] = []
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.kind, self.hash = np.zeros(1024, np.int8), np.zeros(1024, np.uint64)

    def numbers(self, found: list[str]) -> np.ndarray:
        """The number of each chunk; new ones are learned first, all together."""
        new = [c for c in set(found) if c not in self]
        if new:
            self._learn(new)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))

    def _learn(self, chunks: list[str]) -> None:
        cut = list(map(TOKEN.findall, chunks))
        tokens = [t for c in cut for t in c]
        low = [t.casefold() for t in tokens]
        digest = xxhash.xxh64_intdigest
        n, m = len(self), len(self.words)
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        self.count = _put(self.count, n, counts)
        self.first = _put(self.first, n, m + np.cumsum(counts) - counts)
        self.kind = _put(self.kind, m, np.fromiter(map(classify, tokens, low), np.int8, len(low)))
        self.hash = _put(self.hash, m, np.fromiter((digest(w, 7) for w in low), np.uint64,
                                                   len(low)) | np.uint64(7))
        self.words += tokens
        self.update(zip(chunks, range(n, n + len(chunks))))


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """`array` with `values` from `at` on, twice as long where they do not fit."""
    if at + len(values) > len(array):
        array = np.resize(array, 2 * (at + len(values)))
    array[at:at + len(values)] = values
    return array


def template(text: str, chunks: Chunks) -> tuple[np.ndarray, list[np.ndarray]]:
    """`(numbers of the template's tokens among the chunks' words, their kinds by form)`.

    A unit counts only after a number.  Inside sentences a name is a capitalised word that does
    not begin one; a line feed ends a sentence.
    """
    if len(chunks) > CACHE:
        chunks.reset()
    numbers = chunks.numbers(text.replace("\n", " . ").split())
    count = chunks.count[numbers]
    ends = np.cumsum(count)
    tokens = np.repeat(chunks.first[numbers] - ends + count, count)
    tokens += np.arange(len(tokens))
    kinds = chunks.kind[tokens]
    before = np.r_[np.int8(END), kinds[:-1]]
    kinds[(kinds == UNIT) & (before != NUMBER)] = LITERAL
    stay = kinds != END
    tokens, kinds, begins = tokens[stay], kinds[stay], before[stay] == END
    capital = kinds == CAPITAL
    inside = capital & ~begins
    none = np.where(capital, np.int8(LITERAL), kinds) if capital.any() else kinds
    some = (np.where(capital & begins, np.int8(LITERAL), kinds) if inside.any() else none)
    return tokens, [some, none, kinds]     # equal ones are one array


@lru_cache(maxsize=None)     # counts are powers of two
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = np.ones((2, count), np.uint64)
    for row, base in zip(out, (BASE, inverse)):
        row[1:] = base
        np.multiply.accumulate(row, out=row)
    return out[0], out[1]


def windows(hashes: np.ndarray, kinds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window, and whether at least half its tokens are literal.

    A window's hash is the polynomial of `width` and its tokens' hashes; differences of
    prefix sums give it for every window at once.
    """
    n = len(hashes) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    power, inverse = _powers(1 << max(10, len(hashes).bit_length()))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * inverse[:len(hashes)], out=sums[1:])
    total = (sums[width:] - sums[:-width]) * power[width - 1:len(hashes)]
    total += np.uint64(width * pow(BASE, width, 1 << 64) % (1 << 64))
    total ^= total >> np.uint64(29)
    literal = np.zeros(len(kinds) + 1, np.int32)
    np.cumsum(kinds == LITERAL, out=literal[1:])
    return total * np.uint64(BASE), (literal[width:] - literal[:-width]) * 2 >= width


def slots_of(tokens: list[str], kinds: np.ndarray) -> tuple[str, list[str]]:
    """Which slots of a window are equal, and their typed values."""
    values = [f"{kinds[i]}:{tokens[i].casefold()}" for i in np.flatnonzero(kinds != LITERAL)]
    first: dict[str, int] = {}
    return ",".join(str(first.setdefault(v, len(first))) for v in values), values


def _found(text: str, widths: Iterable[int], bitmap: np.ndarray | None, chunks: Chunks
           ) -> Iterator[tuple[int, int, int, int, str, list[str]]]:
    """Windows with more slots than words, and those of items under SHORTEST tokens, count
    without names only, by their values: their pattern is `=` and they have no slots."""
    numbers, forms = template(text, chunks)
    plain = chunks.hash[numbers]
    made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}    # forms may be equal
    for form, kinds in zip(FORMS, forms):
        for width in widths:
            if width < SHORTEST and form != NO_NAMES:
                continue
            key = id(kinds), width
            if key not in made:
                made[key] = windows(np.where(kinds == LITERAL, plain, kinds.astype(np.uint64)),
                                    kinds, width)
            total, enough = made[key]
            by_value = np.zeros(len(total), bool)
            if form == NO_NAMES:
                by_value = ~enough if width >= SHORTEST else ~by_value
                if by_value.any():
                    total = np.where(by_value, windows(plain, kinds, width)[0], total)
                enough = enough | by_value
            if bitmap is not None:
                cell = total >> np.uint64(64 - BITMAP_BITS)
                bit = (cell & np.uint64(7)).astype(np.uint8)
                enough = enough & ((bitmap[cell >> np.uint64(3)] >> bit) & 1 > 0)
            for i in np.flatnonzero(enough):
                pattern, values = "=", []
                if not by_value[i]:
                    tokens = [chunks.words[k] for k in numbers[i:i + width]]
                    pattern, values = slots_of(tokens, kinds[i:i + width])
                yield form, int(i), width, int(total[i].astype(np.int64)), pattern, values


def _window_pass(df: DataFrame, keys: str, widths: list[int], bitmap: np.ndarray | None,
                 whole_short: bool) -> DataFrame:
    """Windows of the last column's texts, with the columns before it."""
    names = [k.split()[0] for k in keys.split(", ")]

    def found_rows(part: pa.RecordBatch, owner: list[int], hits: list[tuple]) -> pa.RecordBatch:
        at = pa.array(owner)
        form, pos, width, total, pattern, values = zip(*hits)
        return pa.RecordBatch.from_arrays(
            [*(c.take(at) for c in part.columns[:-1]),  # never the text, once for each hit
             pa.array(form, pa.int32()), pa.array(pos, pa.int32()), pa.array(width, pa.int32()),
             pa.array(total, pa.int64()), pa.array(pattern, pa.string()), pa.array(values, pa.list_(pa.string()))],
            names=[*names, "form", "pos", "width", "hash", "pattern", "slots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            for part in pieces(batch):
                owner, hits = [], []
                for row, text in enumerate(part.column(part.num_columns - 1)):
                    text = text.as_py() or ""
                    own = widths
                    if whole_short:
                        n = len(template(text, chunks)[0])
                        own = [min(n, WINDOW)] if n > 1 else []
                    for hit in _found(text, own, bitmap, chunks):
                        owner.append(row)
                        hits.append(hit)
                        if len(hits) == HITS:
                            yield found_rows(part, owner, hits)
                            owner, hits = [], []
                if hits:
                    yield found_rows(part, owner, hits)

    return df.mapInArrow(run, f"{keys}, {SCHEMA}")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The filter: 2**BITMAP_BITS bits in slices that tasks fill and merge by OR."""
    size = 1 << (SLICE_BITS - 3)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                             >> np.uint64(64 - BITMAP_BITS))
            number = (cell >> np.uint64(SLICE_BITS)).astype(np.int64)
            keys, parts = np.unique(number), []
            for k in keys:
                bits = np.zeros(1 << SLICE_BITS, np.uint8)
                bits[(cell[number == k] & np.uint64((1 << SLICE_BITS) - 1)).astype(np.int64)] = 1
                parts.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_pydict({"slice": keys, "bits": parts}, schema=pa.schema(
                [("slice", pa.int64()), ("bits", pa.binary())]))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        bits = np.zeros(size, np.uint8)
        for part in table["bits"]:
            bits |= np.frombuffer(part.as_py(), np.uint8)
        return pa.table({"slice": [key[0].as_py()], "bits": [bits.tobytes()]})

    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    schema = "slice long, bits binary"
    for r in (hashes.mapInArrow(fill, schema).groupBy("slice")
              .applyInArrow(merge, schema).collect()):  # 128 slices of 8 KB at most
        out[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS
                 ) -> DataFrame:
    """Rows and the benchmark items they hold: doc_id, row_key, item_id, n_windows,
    item_windows, verbatim.

    `n_windows` is the most windows of the item found in one alignment under one of the FORMS;
    all of them, or `min_windows`, make a finding.  `verbatim` tells whether the slots' values
    are the item's own, under every form.  Items of one token and null texts are never found;
    items shorter than a window are looked for whole, those under SHORTEST tokens and windows
    with more slots than words with their own values only.  Repeated rows share a row_key and
    give one finding; empty tables give none; other columns are ignored.
    """
    items = materialize(_window_pass(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"),
        "item_id long", [], None, whole_short=True), "item-windows")
    # WINDOW, and the lengths of items shorter than that.
    widths = [r["width"] for r in items.select("width").distinct().orderBy("width").collect()]
    bitmap = _bitmap(items.select("hash"))
    hits = materialize(_window_pass(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
                    "text"),
        "doc_id long, row_key long", widths, bitmap, False), "hits")
    sizes = items.groupBy("item_id", "form").agg(F.countDistinct("pos").alias("item_windows"))
    both = hits.join(items.select("item_id", "form", F.col("pos").alias("item_pos"), "hash",
                                  "pattern", F.col("slots").alias("item_slots")),
                     ["form", "hash", "pattern"])
    aligned = (both.groupBy("row_key", "doc_id", "item_id",
                            (F.col("pos") - F.col("item_pos")).alias("shift"), "form")
               .agg(F.countDistinct("item_pos").alias("n"),
                    F.array_distinct(F.flatten(F.collect_set(
                        F.arrays_zip("item_slots", "slots")))).alias("pairs")))
    one_to_one = F.expr("size(pairs) = size(array_distinct(pairs.item_slots))"
                        " and size(pairs) = size(array_distinct(pairs.slots))")
    passes = one_to_one & (F.col("n") >= F.least(F.lit(min_windows), "item_windows"))
    return (aligned.join(sizes, ["item_id", "form"])
            .groupBy("row_key", "doc_id", "item_id", "shift")
            .agg(F.max(F.when(passes, F.struct("n", "item_windows"))).alias("best"),
                 F.min(F.expr("forall(pairs, p -> p.item_slots = p.slots)")).alias("verbatim"))
            .where("best is not null")
            .groupBy("row_key", "doc_id", "item_id")
            .agg(F.max("best").alias("best"), F.max("verbatim").alias("verbatim"))
            .select("doc_id", "row_key", "item_id", F.col("best.n").alias("n_windows"),
                    "best.item_windows", "verbatim"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS
                  ) -> DataFrame:
    """The rows of `docs` in which no benchmark item was found, with all their columns."""
    found = materialize(contaminated(docs, benchmark, min_windows).select("row_key").distinct(),
                        "contaminated")
    return (docs.select(row_key().alias("row_key"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .join(found, "row_key", "left_anti").select("row.*"))
