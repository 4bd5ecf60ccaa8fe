"""Shards, packing, token counts, licenses, decontamination and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from brookmart.llm import decontamination as D
from brookmart.llm import licenses as L
from brookmart.llm import packing as P
from brookmart.llm import sharding as H
from brookmart.llm import simhash
from brookmart.llm import tokens as K
from brookmart.llm.oracle import ORACLES
from brookmart.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.data import awkward, awkward_rows, empty, lower, prose, roots


# ---- shards -----------------------------------------------------------------------------

def check_shards(rows, texts, shards):
    by_shard = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by_shard[r.shard].append(r.slot)
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                   for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    home = defaultdict(set)
    for r in rows:
        home[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in home.values())


@pytest.mark.parametrize("run_groups", [100_000, 7])
def test_shards(spark, run_groups):
    """Small runs take the path of classes cut by hash."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = H.shard(docs, 24, run_groups).collect()
    check_shards(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], 24)
    loads, groups = Counter(), Counter()
    for r in rows:
        loads[r.shard] += r.size
        groups[r.size, r.text_crc32] += r.size
    assert max(loads.values()) - min(loads.values()) <= max(groups.values())


def test_shards_of_awkward_rows(spark):
    rows = H.shard(awkward(spark), 5).collect()
    check_shards(rows, [r[:2] for r in awkward_rows()], 5)
    assert H.shard(empty(spark)).collect() == []


def test_shards_of_thousands_of_large_classes(spark):
    """With runs of one group every class of two groups or more counts as large."""
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "concat(repeat('x', cast(id / 2 as int)), cast(id as string)) as text")
    rows = H.shard(docs, 24, 1).collect()
    check_shards(rows, [tuple(r) for r in docs.collect()], 24)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) <= max(r.size for r in rows)


def test_shards_of_one_row_repeated(spark):
    docs = spark.range(3000).selectExpr("if(id < 1000, 7, id) as doc_id", "'same' as text")
    rows = H.shard(docs, 5).collect()
    check_shards(rows, [tuple(r) for r in docs.collect()], 5)


def test_dealing_runs_is_as_level_as_dealing_one_by_one():
    rng = random.Random(1)
    runs = [(i, rng.randrange(1, 5000), float(rng.randrange(1, 10_000))) for i in range(60)]
    quotas = H.deal(runs, 24)
    loads = [0.0] * 24
    for i, n, size in runs:
        assert sum(quotas[i]) == n and min(quotas[i]) >= 0
        loads = [x + q * size for x, q in zip(loads, quotas[i])]
    single = [0.0] * 24
    for size in sorted((s for _, n, s in runs for _ in range(n)), reverse=True):
        low = single.index(min(single))
        single[low] += size
    smallest = min(s for _, _, s in runs)
    assert max(loads) <= max(single) + smallest and min(loads) >= min(single) - smallest


# ---- packing ----------------------------------------------------------------------------

def check_packing(rows, totals, capacities):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence].append(r)
        pieces[r.doc_id].append((r.start, r.length))
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: (r.offset, r.length)):
            assert r.offset == at
            at += r.length
        assert {r.capacity for r in own} == {next(c for c in capacities if c >= at)}
    for doc_id, total in totals.items():
        at = 0
        for start, length in sorted(pieces.pop(doc_id)):
            assert start == at
            at += length
        assert at == total
    assert not pieces


@pytest.mark.parametrize("group", [20_000, 30])
def test_packing(spark, group):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.pack(docs, capacities=(64, 128, 256, 512), group_pieces=group).collect()
    totals = {r.doc_id: len(r.text.encode().split()) + 1 for r in docs.collect()}
    check_packing(rows, totals, (64, 128, 256, 512))
    used = sum(totals.values())
    room = sum({r.sequence: r.capacity for r in rows}.values())
    assert room < 1.1 * used


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = P.pack(docs, capacities=(8, 100)).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in awkward_rows()}
    long = [r for r in rows if r.doc_id == 6]
    assert sum(r.length for r in long) == 120_001 and len(long) == 1_201
    assert P.pack(empty(spark)).collect() == []


def test_cheapest_plan():
    rng = random.Random(2)
    lengths = sorted((rng.randrange(0, 900) for _ in range(400)), reverse=True)
    sizes = (256, 512, 1024)
    best = sum(map(P.cost, P.cheapest(lengths, sizes)[2]))
    for least in (0, *sizes):
        sequence, offset, capacity = P.best_fit(lengths, sizes, least)
        assert best <= sum(map(P.cost, capacity))
        used = Counter()
        for s, o, n in zip(sequence, offset, lengths):
            assert o == used[s]
            used[s] += n
        assert all(used[s] <= c for s, c in enumerate(capacity))
    # A few short pieces do not open the largest size.
    assert P.cheapest([10, 5], sizes)[2] == [256]


# ---- token counts -----------------------------------------------------------------------

def slow_counts(text, starts, rule):
    with open(K.VOCABULARY, "rb") as file:
        encoder, sizes = K.encoding(file.read(), K.PATTERN)
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    counts, at = [0.0] * len(starts), 0
    for token in encoder.encode_ordinary(text):
        chars = owner[at:at + int(sizes[token])]
        at += int(sizes[token])
        first, last = chars[0], chars[-1]
        home = [max(i for i, s in enumerate(starts) if s <= c) for c in range(first, last + 1)]
        if rule == "start":
            counts[home[0]] += 1
        elif rule == "end":
            counts[home[-1]] += 1
        elif rule == "majority":
            counts[max(sorted(set(home)), key=home.count)] += 1
        else:
            for h in home:
                counts[h] += 1 / len(home)
    return counts


@pytest.mark.parametrize("rule", K.RULES)
def test_token_counts(spark, rule):
    rng = random.Random(3)
    texts = ["", "Hello  world\n\n\nnext line\r\n  indented", "né 🙂🙂 𝔘x\n\n\n", "<|endoftext|> a",
             " ".join(prose(1, 50)), "\n\n\n\n"]
    rows = [(i, t, sorted(rng.sample(range(1, max(len(t), 8)), min(5, max(len(t) - 1, 1)))))
            for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cuts array<int>")
    got = defaultdict(dict)
    for r in K.count_sections(docs, rule, starts="cuts").collect():
        got[r.doc_id][r.section] = r
    crossing = 0
    for i, t, cuts in rows:
        starts = [0] + [c for c in cuts if c < len(t)]
        own = [got[i][s] for s in range(len(starts))]
        assert [r.start_char for r in own] == starts
        assert [r.end_char for r in own] == starts[1:] + [len(t)]
        assert [r.n_tokens for r in own] == pytest.approx(slow_counts(t, starts, rule))
        assert sum(r.n_tokens for r in own) == pytest.approx(own[0].doc_tokens)
        crossing += sum(r.n_crossing for r in own)
    assert crossing > 0


def test_token_counts_of_awkward_rows(spark):
    rows = K.count_sections(awkward(spark)).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in awkward_rows()}
    assert sum(r.doc_id == 10 for r in rows) == 3
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id == 4] == [(0, 0.0)]
    assert len([r for r in rows if r.doc_id == 14]) == 3
    assert K.count_sections(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        K.count_sections(awkward(spark), "middle")


# ---- licenses ---------------------------------------------------------------------------

def as_duck(con, name, df):
    con.register(name, df.toPandas())


def same_as_oracle(df, con, sql):
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    want = con.sql(sql).select(*columns).fetchall()
    assert Counter(got) == Counter(want)


LICENSED = [
    "under the MIT license", "Under, the -- mit LICENSE!", "under the mit licenses",
    "thunder the mit license", "under the mit license\x00cc by nc CC-BY-NC apache license version 2",
    "under the\nmit license", "LICENSED under CC BY-NC 4.0.", "cc by ncé",
    "Licensed under the Apache License, Version 2.0 (the License)",
    "This work is licensed under the GNU General Public License, version 3.",
    "This work is licensed under the General Public License, version 3.",
    "apache license version 2 0 licensed the\nunder", "Kcc by nc", "cc by nc",
    "to the extent possible under law the author has waived all copyright", "version 2 license",
]


def test_license_scan_by_oracle(spark):
    rows = [r[:2] for r in awkward_rows()] + list(enumerate(LICENSED, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    as_duck(con, "documents", docs)
    same_as_oracle(L.scan(docs), con, ORACLES["op8_license_scan"])
    assert L.scan(awkward(spark)).count() == len(awkward_rows())
    assert L.scan(empty(spark)).collect() == []


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_license_filters_lose_no_pair(spark, threshold):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(14)]
    templates = tuple((f"t{k}", " ".join(rng.sample(words, rng.randrange(1, 8))))
                      for k in range(12))
    texts = ["\n".join(" ".join(rng.choices(words + ["z"], k=rng.randrange(0, 9)))
                       for _ in range(3)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in L.scan(docs, templates, threshold).collect():
        best = {}
        for line in texts[r.doc_id].split("\n"):
            for label, t in templates:
                own = set(t.split())
                share = len(own & set(line.split())) / len(own)
                if share >= threshold - 1e-9:
                    best[label] = max(share, best.get(label, 0))
        assert r.labels == ",".join(sorted(best))
        assert r.score == pytest.approx(max(best.values(), default=0.0))


def test_wrapped_notices(spark, tmp_path):
    """Every template, wrapped at several widths, among other lines; the query's own blocks."""
    texts, want = [], []
    for label, template in L.TEMPLATES:
        for width in (1, 3, 8):
            w = template.split()
            lines = [" * " + " ".join(w[i:i + width]) for i in range(0, len(w), width)]
            texts.append("\n".join(["Some title", "", "/*", *lines, " */", "", "more text"]))
            want.append(label)
        texts.append("\n \t\n".join(template.split()))   # words in paragraphs of their own
        want.append(None)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op8_license_scan"](spark, str(tmp_path)).collect()}
    for i, label in enumerate(want):
        if label is None:
            assert rows[i].labels == rows[i].base_labels
        else:
            assert label in rows[i].labels.split(",") and rows[i].score == 1.0


# ---- decontamination --------------------------------------------------------------------

ITEMS = [
    (1, "A train leaves Springfield at 9 and travels 120 km at 60 km per hour. "
        "How long does the trip of the train take in all?"),
    (2, "Is water wet enough here?"), (3, "tiny"), (4, None), (5, ""),
    (6, "Anna gives Bob 3 apples and Bob gives Anna 4 pears, so how many fruits has Anna now?"),
]


def test_reparameterised_questions(spark):
    docs = [
        (1, "Intro. " + ITEMS[0][1] + " Outro."),
        (2, "x A train leaves Riverton at 7 and travels 300 miles at 50 miles per hour. "
            "How long does the trip of the train take in all? y"),
        (3, "they say is WATER wet, enough here and more"),
        (4, "Anna gives Bob 3 apples and Bob gives Anna 4 pears, so how many fruits has Anna now?"),
        (5, "It was Carl gives Dora 8 apples and Dora gives Carl 9 pears, so how many fruits has "
            "Carl now?"),
        (6, "It was Carl gives Dora 8 apples and Emil gives Fred 9 pears, so how many fruits has "
            "Gina now?"),
        (7, "tiny"), (8, None), (9, " ".join(prose(5, 300))), (10, "1 2 3 4 5 6 7 8 9 10 11 12"),
        (11, "A train leaves early and how long does it take in all"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.verbatim for r in D.contaminated(frame, bench).collect()}
    assert got == {(1, 1): True, (2, 1): False, (3, 2): True, (4, 6): True, (5, 6): False}
    left = D.decontaminate(frame, bench)
    assert {r.doc_id for r in left.collect()} == {6, 7, 8, 9, 10, 11}


def contaminations(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.verbatim for r in D.contaminated(docs, bench).collect()}


def test_names_anywhere_and_copies_in_other_cases(spark):
    items = ["Anna has 3 apples. Ben has 4 pears. Anna gives Ben 2 apples. How many has Anna?",
             "Anna has 3 apples and eats 2 of them.",
             "Der Zug nach Berlin hat am Morgen drei Wagen mit Kohle und auf der Straße steht "
             "noch ein Wagen mit Holz"]
    wrapped = items[2].split()
    wrapped = "\n".join(" ".join(wrapped[i:i + 4]) for i in range(0, len(wrapped), 4))
    got = contaminations(spark, items, [
        "Carl has 5 apples. Dora has 6 pears. Carl gives Dora 7 apples. How many has Carl?",
        "Carl has 5 apples and eats 4 of them.",
        items[2].lower(), items[2].upper(), wrapped, items[0].lower(), items[1].upper(),
        "Carl has 5 apples. Dora has 6 pears. Emil gives Fred 7 apples. How many has Gina?",
        " ".join(prose(6, 200))])
    assert got == {(0, 0): False, (1, 1): False, (2, 2): True, (3, 2): True, (4, 2): True,
                   (5, 0): True, (6, 1): True}


def test_items_of_slots_and_short_items(spark):
    items = ["Compute 12 + 7 * 3 - 5.", "Add 1 2 3 4 5 6 7 8 9 10 11 please", "Solve 17 x",
             "Anna Ben Carl Dora Emil Fred"]
    got = contaminations(spark, items, [
        "First: " + items[0], "Compute 13 + 7 * 3 - 5.", "so add 1 2 3 4 5 6 7 8 9 10 11 please",
        "Add 2 2 3 5 5 6 8 8 9 11 11 please", "now solve 17 x", "Solve 18 x",
        "ANNA BEN CARL DORA EMIL FRED", "Gina Hans Ida Jan Karl Lena", "5 6 7 8 9 10 11 12 13 14"])
    assert got == {(0, 0): True, (2, 1): True, (4, 2): True, (6, 3): True}


def test_decontamination_against_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    squeeze = lambda t: " ".join(t.lower().split())
    items = [(r.item_id, squeeze(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in squeeze(r.text)}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert want and want == got


def test_decontamination_of_awkward_rows(spark):
    bench = spark.createDataFrame(
        [(1, "other"), (2, "word5 stays here word6 stays here word7 stays here word8"), (None, "a")],
        "item_id long, text string")
    left = D.decontaminate(awkward(spark), bench)
    assert left.columns == awkward(spark).columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(
        r[0] for r in awkward_rows() if r[0] not in (6, 7))
    none = bench.limit(0)
    assert D.contaminated(awkward(spark), none).collect() == []
    assert D.decontaminate(awkward(spark), none).count() == len(awkward_rows())
    assert D.decontaminate(empty(spark), bench).collect() == []


# ---- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    bench = [" ".join(lower(r.text).split())
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = docs, stage(spark, docs, SF)
        assert out.columns == before.columns
        rows, old = out.collect(), before.collect()
        assert set(rows) <= set(old) and len(rows) == len(set(rows))
        docs = spark.createDataFrame(rows, before.schema)
        if name == "exact_dedup":
            best = {}
            for r in old:
                best[lower(r.text)] = max(best.get(lower(r.text), -1), r.doc_id)
            assert {r.doc_id for r in rows} == set(best.values())
        if name == "near_dedup":
            prints = {r.doc_id: int(r.fingerprint, 16)
                      for r in simhash.near_components(before).collect()}
            ids = list(prints)
            root = roots(prints.values(), lambda x, y: (x ^ y).bit_count() <= 4)
            best = {}
            for i, r in zip(ids, root):
                best[r] = min(i, best.get(r, i))
            assert {r.doc_id for r in rows} == set(best.values())
        if name == "decontamination":
            assert {r.doc_id for r in old} - {r.doc_id for r in rows} == {
                r.doc_id for r in old if any(b in " ".join(lower(r.text).split()) for b in bench)}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(packed, {r.doc_id: len(r.text.encode().split()) + 1 for r in docs.collect()},
                  P.CAPACITIES)


def test_pipeline_stages_on_awkward_rows(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).collect() == []
        assert stage(spark, awkward(spark), SF).count() > 0


# ---- registration -----------------------------------------------------------------------

def test_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    same_as_oracle(QUERIES[name](spark, SF), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_runs(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.isin(name.split("_")[0], ["op6", "op7", "op10"]) or len(rows) == n
