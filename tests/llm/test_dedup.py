"""Exact duplicates, SimHash components and near copies against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from brookmart.llm import exact_dedup as E
from brookmart.llm import simhash as S
from brookmart.llm.common import components
from tests.llm.data import awkward, awkward_rows, empty, lower, prose, roots


# ---- exact ------------------------------------------------------------------------------

def expected_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[lower(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep,
                    hashlib.sha256(lower(text).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [64, 6])
def test_exact_dedup(spark, bits):
    """With six bits nearly all fingerprints collide, and byte verification decides."""
    got = E.exact_dedup(awkward(spark), fingerprint_bits=bits).collect()
    assert Counter(map(tuple, got)) == Counter(expected_groups(awkward_rows()))


def test_keep_first(spark):
    got = E.keep_first(awkward(spark))
    assert got.columns == awkward(spark).columns
    want = {(lower(t), k) for (_, t, *_), (_, k, *_) in
            zip(awkward_rows(), expected_groups(awkward_rows()))}
    rows = got.collect()
    assert Counter((lower(r.text), r.doc_id) for r in rows) == Counter(want)
    assert all(r.norm == "d" and r.row == "c" for r in rows)


def test_exact_empty(spark):
    assert E.exact_dedup(empty(spark)).collect() == []
    assert E.keep_first(empty(spark)).collect() == []


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 20, 20_000).astype(np.uint64)
    parts = {}
    for piece in np.array_split(prints, 7):
        for q, remainders, counts in E.build_filter(piece, 5, 20):
            assert (np.diff(remainders.astype(np.int64)) > 0).all()
            parts.setdefault(q, []).append((remainders, counts))
    merged = Counter()
    for q, p in parts.items():
        for r, c in zip(*E.merge_buckets(p)):
            merged[q << 15 | int(r)] = int(c)
    assert merged == Counter(prints.tolist())


# ---- SimHash ----------------------------------------------------------------------------

def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64)
               if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_rows():
    """Families of texts a few words apart, besides the awkward ones."""
    rows = [r[:2] for r in awkward_rows() if r[1] is None or len(r[1]) < 10_000]
    rng = random.Random(5)
    for family in range(6):
        words = prose(family, 150)
        for copy in range(8):
            own = list(words)
            for _ in range(copy % 3):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            rows.append((100 + family * 10 + copy, " ".join(own)))
    return rows


def test_near_components(spark):
    rows = near_rows()
    got = S.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (doc_id, _), r in zip(rows, root):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    want = Counter((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, root))
    assert Counter(map(tuple, got)) == want
    assert len({least.get(r) for r in root}) < len(set(prints))  # some do link


def test_near_components_of_awkward_rows(spark):
    got = S.near_components(awkward(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward_rows())
    zero = {r.doc_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {3, 4, 5, None}
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {3}


def test_near_components_empty(spark):
    assert S.near_components(empty(spark)).collect() == []


def test_every_pair_within_four_bits_meets():
    rng = np.random.default_rng(1)
    for bits in range(5):
        for _ in range(60):
            a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
            b = a
            for i in rng.choice(64, bits, replace=False):
                b ^= 1 << int(i)
            keys = [set(S.anchors(np.array([x], np.uint64))[1].tolist()) for x in (a, b)]
            assert keys[0] & keys[1]


def test_code_words_cover_all():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 3_000).astype(np.uint32)
    again = S.nearest(words)
    # The code word with those leading bits lies within three bits of the word.
    high = again << np.uint32(11)
    parity = np.array([next(p for p in range(2048) if int(S.nearest(
        np.array([h | p], np.uint32))[0]) == int(h) >> 11 and bin((int(h) | p) ^ int(w)).count("1")
        <= 3) for h, w in zip(high[:20], words[:20])])
    assert len(parity) == 20


@pytest.mark.parametrize("block", [4096, 8])
def test_links_of_a_dense_cluster(spark, block):
    """One cluster of hundreds at the same anchors: small blocks take the path for hot ones."""
    rng = np.random.default_rng(7)
    centre = int(rng.integers(1, 1 << 62))
    prints = {centre}
    for _ in range(150):
        x = centre
        for i in rng.choice(64, int(rng.integers(1, 4)), replace=False):
            x ^= 1 << int(i)
        prints.add(x)
    prints |= {int(x) for x in rng.integers(1, 1 << 62, 60)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p, 0, p) for p in signed], "id long, salt int, fp long")
    got = {r.node: r.root for r in components(S.hamming_links(df, 4, block)).collect()}
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for s, r in zip(signed, root):
        groups.setdefault(r, set()).add(s)
    for members in groups.values():
        for m in members:
            assert got.get(m, m) == min(members)


def plain_fingerprint(text):
    words = lower(text).split()     # the tests' texts hold no other white space
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64)
               if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def check_by_brute_force(spark, rows):
    """One row stays of each component of the graph of fingerprints at most 4 bits apart."""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    best = {}
    for row, r in zip(rows, root):
        best[r] = min(best.get(r, row), row, key=lambda x: (x[0] is None, x[0] or 0))
    got = S.drop_near_duplicates(spark.createDataFrame(
        [(*r, "x") for r in rows], "doc_id long, text string, fp string"))
    assert got.columns == ["doc_id", "text", "fp"]
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in best.values())
    return len(best)


def test_near_copies_go(spark):
    rng = random.Random(9)
    rows = []
    for family in range(8):
        words = prose(100 + family, 300)
        for copy in range(5):
            own = list(words)
            for _ in range(copy):
                own[rng.randrange(len(own))] = f"new{copy}"
            rows.append((family * 10 + copy, " ".join(own)))
    clean = [(1000 + i, " ".join(prose(500 + i, 120))) for i in range(30)]
    rows += clean + [(None, None), (3000, ""), (3001, "  "), (2, rows[2][1]), (2, rows[2][1])]
    rng.shuffle(rows)
    assert len(clean) + 9 <= check_by_brute_force(spark, rows) < len(clean) + 30


def test_a_family_of_edited_copies(spark):
    """120 texts, each some words away from the same one."""
    rng = random.Random(21)
    base, rows = prose(5000, 300), []
    for copy in range(120):
        own = list(base)
        for i in rng.sample(range(300), rng.randrange(1, 9)):
            own[i] = f"p{copy}x{i}"
        rows.append((500 - copy, " ".join(own)))
    assert check_by_brute_force(spark, rows) < 120


def test_near_copies_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward_rows()]
    got = S.drop_near_duplicates(awkward(spark)).collect()
    full = {r[:2]: plain_fingerprint(r[1]) for r in rows}
    root = roots(full.values(), lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(got) == len(set(root)) and {(r.doc_id, r.text) for r in got} <= set(full)
    assert S.drop_near_duplicates(empty(spark)).collect() == []
