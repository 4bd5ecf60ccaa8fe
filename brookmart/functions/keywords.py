"""Word splitting and turning counters into rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latin words and numbers, or an unbroken run of CJK characters.
WORD_PATTERN = r"[a-z0-9]+|[一-鿿]+"


def tokenize(text: Column | str, segmenter: Callable[[Column], Column] | None = None) -> Column:
    """The distinct words of a text, as an array.

    Pass a vectorised `pandas_udf` (string -> array<string>) as `segmenter` to cut
    CJK text by a dictionary; the default stays inside the JVM.
    """
    text = F.col(text) if isinstance(text, str) else text
    words = segmenter(text) if segmenter else F.regexp_extract_all(
        F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.array_distinct(words)


def explode_words(df: DataFrame, text: str, word: str = "word",
                  segmenter: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per distinct word; a text without words gives no row."""
    return df.withColumn(word, F.explode(tokenize(text, segmenter)))


def positive_counters(df: DataFrame, counters: list[str],
                      source: str = "source", ct: str = "ct") -> DataFrame:
    """One row (source, ct) per counter above zero, the counter name as source."""
    pairs = F.array(*[F.struct(F.lit(c).alias(source), F.col(c).alias(ct)) for c in counters])
    rest = [c for c in df.columns if c not in counters]
    return (df.select(*rest, F.inline(pairs))
              .where(F.col(ct) > 0))


def any_positive(df: DataFrame, counters: list[str]) -> DataFrame:
    """Rows in which at least one counter is above zero."""
    return df.where(F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in counters]) > 0)
