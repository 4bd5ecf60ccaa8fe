"""License scans by an exact set-similarity join, in SQL functions only.

A text block (the set of words of a line, or of a paragraph) holds a license if it contains at least `THRESHOLD` of
the words of one of its templates.  Words are ordered by how many documents of the corpus
have them, rarest first.  A block that contains enough of a template must share one of the
template's first words in that order (prefix), be large enough itself (length), and have
enough words left after the first shared one (position); only pairs that pass all three are
compared in full.  The filters never drop a pair that would pass.

Templates are a fixed list, so they travel as a literal and no row is shuffled but the
counts of the templates' words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import LOWER, UPPER

# A word's characters before lower-casing, and what stands between words.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# The base phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))

# Notices as licenses word them, lower case, without punctuation.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software "
            "foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related "
            "rights to this work"),
)
THRESHOLD = 0.9

# What stands between blocks.  Every run of lines without a blank one among them is part of a
# paragraph and its words are the paragraph's, so wrapped notices need no blocks of their own.
LINE = r"\n"
PARAGRAPH = r"\r?\n[ \t\x0B\f\r]*\n"


def phrase_pattern(*phrases: str) -> str:
    """Places where the words of a phrase stand consecutively, A-Z in either case."""
    either = "|".join(f"{GAP}+".join(p.split()) for p in phrases)
    return f"(?i)(?<!{WORD})(?:{either})(?!{WORD})"


def word_order(docs: DataFrame, words: list[str]) -> list[str]:
    """`words` by the number of documents that have them, rarest first, over all of `docs`."""
    known = F.array(*map(F.lit, words))
    rows = (docs.select(F.explode(F.array_intersect(
        known, F.split(F.lower(F.coalesce("text", F.lit(""))), f"{GAP}+"))).alias("word"))
        .groupBy("word").count().collect())  # one line for each template word at most
    counts = {r["word"]: r["count"] for r in rows}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _strings(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def template_matches(order: list[str], templates=TEMPLATES, threshold: float = THRESHOLD,
                     between: str = LINE) -> Column:
    """Array of (label, containment) of the pairs of a block and a template that match."""
    rank = {w: i for i, w in enumerate(order)}
    made, first_words, least = [], set(), 1 << 30
    for label, text in templates:
        words = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        prefix = words[:len(words) - need + 1]
        first_words |= set(prefix)
        least = min(least, need)
        made.append(f"named_struct('label', '{label}', 'words', {_strings(words)}, 'prefix', "
                    f"{_strings(prefix)}, 'need', {need})")
    blocks = (f"filter(transform(split(translate(text, '{UPPER}', '{LOWER}'), between), part -> "
              f"array_intersect({_strings(order)}, split(part, gap))), b -> size(b) >= {least})")
    shared = "element_at(array_intersect(t.prefix, b), 1)"
    join = f"""
        flatten(transform({blocks}, b -> transform(
            filter(array({', '.join(made)}), t ->
                size(b) >= t.need
                and arrays_overlap(t.prefix, b)
                and 1 + least(size(t.words) - array_position(t.words, {shared}),
                              size(b) - array_position(b, {shared})) >= t.need
                and size(array_intersect(t.words, b)) >= t.need),
            t -> named_struct('label', t.label, 'score',
                              size(array_intersect(t.words, b)) / cast(size(t.words) as double)))))
    """
    # Texts without any prefix word hold no block that could match.
    low = F.lower(F.col("text"))
    may = F.lit(False)
    for word in sorted(first_words):
        may = may | F.contains(low, F.lit(word))
    empty = F.expr("cast(array() as array<struct<label: string, score: double>>)")
    return F.when(may, F.expr(join)).otherwise(empty)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
         between: str = LINE) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    `labels` are the base phrases' and the templates'; `score` is 1 with a base phrase, else
    the largest containment of a matching template, else 0.  `between` cuts the text into
    blocks, by LINE or by PARAGRAPH, which finds wrapped notices too.  Null counts as empty; a block of
    any length is looked at whole.  Repeated rows and null ids come out as they come in;
    other columns are ignored; an empty table gives no rows.
    """
    order = word_order(docs, sorted({w for _, text in templates for w in text.split()}))
    every = phrase_pattern(*(p for p, _ in PHRASES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"), F.lit(f"{GAP}+").alias("gap"),
                       F.lit(between).alias("between"))
    rows = rows.select(
        "doc_id", "text", F.regexp_count("text", F.lit(f"{WORD}+")).cast("long").alias("n_words"),
        F.regexp_count("text", F.lit(every)).cast("long").alias("n_base"),
        template_matches(order, templates, threshold, between).alias("matches"))
    has = F.col("n_base") > 0
    before_first = F.element_at(F.split("text", every, 2), 1)
    before_last = F.regexp_extract("text", "(?s)^(.*)" + every, 1)
    base = F.filter(F.array(*[F.when(F.col("text").rlike(phrase_pattern(p)), F.lit(label))
                              for p, label in PHRASES]), lambda x: x.isNotNull())
    base = F.when(has, base).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("base", base)

    def place(before: Column) -> Column:
        return F.when(has, F.regexp_count(before, F.lit(f"{WORD}+")).cast("long"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return rows.select(
        "doc_id", "n_words", "n_base", place(before_first).alias("first_word"),
        place(before_last).alias("last_word"), joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.col("matches.label"))).alias("labels"),
        F.when(has, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max("matches.score"), F.lit(0.0))).alias("score"))
