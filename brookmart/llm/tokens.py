"""Token counts by section, from one encoding of each whole document.

A document is encoded once; the tokens' character spans are then interval-joined to the spans
of its sections.  A token that lies across a boundary is allocated by one of four rules:

    start     to the section of its first character
    end       to the section of its last character
    majority  to the section with most of its characters, the earlier one of equals
    split     to all of them, by their shares of its characters

so the counts of all sections add up to the document's own count under every rule.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import arrow_pass

# Fixed value: how the public byte-level vocabulary cuts a text before merging.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("start", "end", "majority", "split")


@lru_cache(maxsize=2)
def encoding(ranks_file: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a vocabulary file's content, and each token's number of bytes."""
    ranks = {base64.b64decode(token): int(rank)
             for token, rank in map(bytes.split, ranks_file.splitlines()) if token}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens={}), sizes


def token_spans(text: str, encoder: tiktoken.Encoding, sizes: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(first character, end)` of each token, and the starts of the text's lines.

    Tokens that are parts of one character all span it.  A line ends after its line feed.
    """
    ends = np.cumsum(sizes[encoder.encode_to_numpy(text, disallowed_special=())])
    data = np.frombuffer(text.encode(), np.uint8)
    chars = np.cumsum((data & 0xC0) != 0x80)
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    breaks = chars[data == 10]
    return (chars[starts] - 1, chars[ends - 1],
            np.r_[0, breaks[breaks < len(text)]].astype(np.int64))


def allocate(first: np.ndarray, end: np.ndarray, starts: np.ndarray, length: int, rule: str
             ) -> tuple[np.ndarray, np.ndarray]:
    """`(tokens, crossing tokens)` of each section; sections cover the text without overlap.

    A crossing token counts as one in every section it touches.
    """
    n = len(starts)
    a = np.searchsorted(starts, first, "right") - 1
    b = np.searchsorted(starts, end - 1, "right") - 1
    counts, crossing = np.bincount(a[a == b], minlength=n).astype(float), np.zeros(n, np.int64)
    stops = np.r_[starts[1:], length]
    for t in np.flatnonzero(a != b):
        touched = np.arange(a[t], b[t] + 1)
        crossing[touched] += 1
        if rule == "start":
            counts[a[t]] += 1
        elif rule == "end":
            counts[b[t]] += 1
        else:
            share = np.minimum(stops[touched], end[t]) - np.maximum(starts[touched], first[t])
            if rule == "majority":
                counts[touched[share.argmax()]] += 1
            else:
                counts[touched] += share / (end[t] - first[t])
    return counts, crossing


def count_sections(docs: DataFrame, rule: str = "majority", vocabulary: str = VOCABULARY,
                   pattern: str = PATTERN, starts: str | None = None) -> DataFrame:
    """One row per section: doc_id, section, start_char, end_char, n_tokens, n_crossing,
    doc_tokens.

    Sections begin at the characters in the array column `starts` (0 is added, values outside
    the text are left out), by default at line starts.  Null and empty texts have one empty
    section without tokens.  Repeated rows and null ids come out as they come in; other
    columns are ignored; an empty table gives no rows.

    The driver reads the vocabulary file, whose size is fixed, and sends it with the task.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batch: pa.RecordBatch) -> dict:
        encoder, sizes = encoding(content.value, pattern)
        owner, out, total = [], [[] for _ in range(5)], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            first, end, own = token_spans(text, encoder, sizes)
            if starts is not None:
                given = batch.column(2)[row].as_py() or []
                own = np.unique([0, *(s for s in given if s is not None and 0 < s < len(text))])
            counts, crossing = allocate(first, end, own, len(text), rule)
            owner.append(np.full(len(own), row))
            total.append(np.full(len(own), len(first)))
            for column, values in zip(out, (np.arange(len(own)), own, np.r_[own[1:], len(text)],
                                            counts, crossing)):
                column.append(values)
        made = [np.concatenate(c) for c in out]
        return {"doc_id": batch.column(0).take(pa.array(np.concatenate(owner))),
                "section": made[0].astype(np.int32), "start_char": made[1], "end_char": made[2],
                "n_tokens": made[3], "n_crossing": made[4],
                "doc_tokens": np.concatenate(total)}

    given = [F.col(starts).cast("array<long>").alias("starts")] if starts else []
    return arrow_pass(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce("text", F.lit("")).alias("text"), *given), run,
        "doc_id long, section int, start_char long, end_char long, n_tokens double, "
        "n_crossing long, doc_tokens long")
