"""Importance resampling against plain sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brookmart.llm import importance as I
from tests.llm.data import awkward, awkward_rows, empty, lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    own = WORD.findall(lower(text))
    return own, [" ".join(own[i:i + n]) for n in range(1, longest + 1)
                 for i in range(len(own) - n + 1)]


def plain(rows, target, percent=10, least=20, buckets=10_000, longest=1):
    """Scores by the formula, drawn by sorting all of them."""
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets
                       for t in texts for f in features(t, longest)[1])

    corpus, goal = count(t for _, t in rows), count(target)
    big, small = sum(corpus.values()) + 10_000, sum(goal.values()) + 10_000
    out = []
    for i, text in rows:
        own, all_of_them = features(text, longest)
        weight = sum(math.floor(1000 * math.log((goal[b] + 1) * big / ((corpus[b] + 1) * small)))
                     for b in (zlib.crc32(f.encode()) % buckets for f in all_of_them))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(all_of_them), weight, score, None, len(own)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[4] = place
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling(spark, longest):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("math", "proof", "cat", "Dog", "é")) + str(rng.randrange(40))
                         for _ in range(rng.randrange(60)))) for i in range(700)]
    goal = [t for _, t in rows[::7]] + ["proof1 proof2 math3"] * 30
    got = I.resample(spark.createDataFrame(rows, "doc_id int, text string").repartition(5),
                     spark.createDataFrame([(t,) for t in goal], "text string"),
                     percent=25, longest=longest)
    assert Counter(map(tuple, got.collect())) == plain(rows, goal, 25, longest=longest)


def test_repeated_rows_count_each(spark):
    """A row that is a third of the table is drawn as often as its place allows."""
    rows = [(i, f"{'word ' * 25}{i}") for i in range(60)] + [(7, "word " * 30)] * 30
    got = I.resample(spark.createDataFrame(rows, "doc_id long, text string"),
                     spark.createDataFrame([("word",)], "text string"), percent=50)
    assert Counter(map(tuple, got.collect())) == plain(rows, ["word"], 50)


def test_resampling_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward_rows()]
    goal = spark.createDataFrame([("some text", 1), (None, 2), ("", 3)], "text string, key int")
    got = I.resample(awkward(spark), goal, percent=60, least_words=2).collect()
    assert Counter(map(tuple, got)) == plain(rows, ["some text", "", ""], 60, 2)
    assert I.resample(empty(spark), goal).collect() == []
    nothing = I.resample(awkward(spark), goal.limit(0), percent=60, least_words=2).collect()
    assert Counter(map(tuple, nothing)) == plain(rows, [], 60, 2)


@pytest.mark.parametrize("k", [0, 1, 500, 1000])
def test_quickselect(spark, k):
    rng = random.Random(k)
    keys = [(rng.randrange(9), False, rng.randrange(30), i) for i in range(1000)]
    table = spark.createDataFrame([(x,) for x in keys],
                                  "key struct<score long, no_id boolean, doc_id long, tie long>")
    found = I.kth_key(table, k, pivots=9)
    assert (tuple(found) if found else None) == (sorted(keys)[k - 1] if k else None)


def test_one_vector_a_task(spark):
    texts = spark.range(4000, numPartitions=4).select(F.lit("a b c d").alias("text"))
    assert I.bucket_counts(texts).sum() == 16_000
