"""The word transducer and the alignment against the tokenizers themselves."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brookmart.llm import alignment as A
from brookmart.llm import lexicon as X
from brookmart.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.data import awkward, awkward_rows, empty

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BITS = [" ", "  ", "\n", "\t", "\r\n", "　", " ", "\x1c", "\x85", " \n ", "​", "'s",
        "'ll", "'", "<|endoftext|>", "a", "bc", "Ünï", "中文字", "12", "½", "²", "🙂", ".", "--",
        "_", "", "<s>", "▁", "\0", "́"]


def mixed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    with open(X.VOCABULARY, "rb") as file:
        return X.vocabulary(file.read())


def library(special=True):
    made = Tokenizer.from_file(X.VOCABULARY)
    made.encode_special_tokens = not special
    return made


def rows_of(ragged):
    return [ragged.flat[s:s + n].tolist()
            for s, n in zip(ragged.starts.tolist(), ragged.sizes.tolist())]


def lexicon_of(words, vocabulary, folder):
    words = sorted(set(words))
    ids = rows_of(X.Encoder(vocabulary).words(words))
    X.save(X.compile_words(list(zip(words, ids))), folder / "lexicon")
    return X.Transducer(folder / "lexicon")


@pytest.mark.parametrize("special", [True, False])
def test_encoding(vocabulary, tmp_path, special):
    texts = [*mixed(1, 3000), "中" * 3000, "ab" * 2000, "!" * 700, "x" * 65 + " " + "é" * 40]
    lexicon = lexicon_of([b" a", b" bc", b" 12.", b" abc", b" bca", b"a", b"\n", b" '"],
                         vocabulary, tmp_path)
    theirs = library(special)
    want = [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    for own in (None, lexicon):
        encoder = X.Encoder(vocabulary, own, special)
        ids = encoder.texts([t.encode() for t in texts])
        assert rows_of(ids) == want
        assert [t.decode() for t in encoder.decode(ids)] == [
            theirs.decode(w, skip_special_tokens=False) for w in want]
        assert encoder.decimals(ids) == [",".join(map(str, w)).encode() for w in want]


def test_every_character(vocabulary):
    theirs, encoder = library(), X.Encoder(vocabulary)
    texts = [f"{chr(c)} a{chr(c)}1{chr(c)}{chr(c)}. {chr(c)}" for c in range(0x3400)]
    texts += [f"a{chr(c)} {chr(c)}1" for c in range(0x3400, 0x20000, 7) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert rows_of(encoder.texts([t.encode() for t in texts])) == want


def test_automaton_is_minimal(vocabulary, tmp_path):
    """Its states are as many as the words have different sets of endings."""
    words = sorted({f"{a}{b}{c}".encode() for a in ("un", "re", "") for b in ("do", "make", "tie")
                    for c in ("s", "", "ing", "ings")})
    made = X.compile_words([(w, [i]) for i, w in enumerate(words)])
    endings = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(made["final"]) == len({frozenset(e) for e in endings.values()})
    X.save(made, tmp_path / "words")
    lexicon = X.Transducer(tmp_path / "words")
    asked = [*words, b"", b"u", b"undos", b"undoz", b"zzz", b"undoingss"]
    want = [words.index(w) if w in words else -1 for w in asked]
    assert lexicon.places(X.Ragged.of(asked, np.uint8)).tolist() == want
    X.save(X.compile_words([]), tmp_path / "none")
    assert X.Transducer(tmp_path / "none").places(
        X.Ragged.of([b"a", b""], np.uint8)).tolist() == [-1, -1]


def digest_rows(rows):
    theirs, out = library(), Counter()
    for i, text in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        out[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest()] += 1
    return out


def test_digests_of_documents(spark):
    rows = map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text").collect())
    got = QUERIES["op12_transducer_bpe"](spark, SF).collect()
    assert Counter(map(tuple, got)) == digest_rows(rows)


def test_digests_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward_rows()]
    for words in (0, 5, 1000):
        got = X.digests(awkward(spark), lexicon_words=words).collect()
        assert Counter(map(tuple, got)) == digest_rows(rows)
    assert X.digests(empty(spark)).collect() == []
    shown = X.encode(spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string"))
    assert shown.first() == (1, [64, 220, 50256, 275], "a <|endoftext|> b")


def test_frequent_words_count_every_document(spark):
    rows = [(i, f"x common w{i % 3} {'y' * 60}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert X.frequent_words(docs, 4) == [b" common", b" w0", b" w1", b" w2"]
    assert X.frequent_words(docs, 3) == [b" common"] and X.frequent_words(docs, 0) == []


# ---- alignment --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=A.MODEL)


def plain_alignment(rows, model):
    """Every pair of tokens compared by byte ranges."""
    theirs = library(special=False)
    pieces = [bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i)
              else model.id_to_piece(i).replace("▁", " ").encode()
              for i in range(model.get_piece_size())]
    with open(X.VOCABULARY, "rb") as file:
        table = X.vocabulary(file.read()).tokens
    tokens = [t.tobytes() for t in np.split(table.flat, np.cumsum(table.sizes)[:-1])]
    documents, held = [], Counter()
    for _, text in rows:
        a = theirs.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        spelt = [b"".join(tokens[i] for i in a), b"".join(pieces[i] for i in b)]
        if spelt != [f" {text}".encode()] * 2:
            a, b = [], []
        ends = [np.cumsum([len(t[i]) for i in x]).astype(int)
                for t, x in ((tokens, a), (pieces, b))]
        starts = [np.r_[0, e[:-1]] if len(e) else e for e in ends]
        links = []
        for i, x in enumerate(a):
            over = np.flatnonzero((starts[1] < ends[0][i]) & (ends[1] > starts[0][i]))
            links += [(x, b[j]) for j in over]
        cuts = [0, *sorted(set(ends[0].tolist()) & set(ends[1].tolist()))]
        groups = ["|".join(",".join(str(x[k]) for k in range(len(x)) if lo < ends[s][k] <= hi)
                           for s, x in ((0, a), (1, b))) for lo, hi in zip(cuts, cuts[1:])]
        documents.append((a, b, links, groups))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = Counter()
    for (i, _), (a, b, links, groups) in zip(rows, documents):
        out[i, len(a), len(b), len(groups), len(links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links)] += 1
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def test_parts_are_encoded_alone(model):
    """Texts cut at spaces give the ids of whole texts, odd white space or not."""
    with open(X.VOCABULARY, "rb") as one, open(A.MODEL, "rb") as two:
        both = A.TwoEncoders(one.read(), two.read())
    theirs, texts = library(special=False), [t for t in mixed(2, 4000) if t]
    a, b = both.texts([t.encode() for t in texts])
    tokens = both.b.tokens
    for text, x, y in zip(texts, rows_of(a), rows_of(b)):
        whole = model.encode(text)
        if b"".join(tokens.flat[tokens.starts[i]:tokens.starts[i] + tokens.sizes[i]].tobytes()
                    for i in whole) == f" {text}".encode():
            assert (x, y) == (theirs.encode(" " + text, add_special_tokens=False).ids, whole)
        else:
            assert x == y == []


@pytest.mark.parametrize("lane, hot", [(1, 40), (7, 0), (1024, 1 << 20)])
def test_alignment(spark, model, lane, hot):
    rows = list(enumerate(mixed(3, 150))) + [(7, "again and again"), (7, "again and again")]
    got = A.aligned(spark.createDataFrame(rows, "doc_id int, text string").repartition(3),
                    texts=False, lane=lane, hot_pairs=hot)
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == plain_alignment(rows, model)


def test_alignment_of_awkward_rows(spark, model):
    rows = [r[:2] if len(r[1] or "") < 100_000 else (r[0], "long") for r in awkward_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = A.aligned(docs, texts=False).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == plain_alignment(rows, model)
    assert A.aligned(awkward(spark)).count() == len(awkward_rows())
    assert A.aligned(empty(spark)).collect() == []


def test_worker_memory_is_bounded(monkeypatch):
    with open(X.VOCABULARY, "rb") as one, open(A.MODEL, "rb") as two:
        both = A.TwoEncoders(one.read(), two.read())
    monkeypatch.setattr(A, "MEMORY", 50)
    for seed in range(9):
        texts = [f"w{seed} {i} x{i}".encode() for i in range(20)]
        a, b = both.texts(texts)
        assert len(both.index) <= 61 and [both.a.tokens.take(r).flat.tobytes() for r in map(
            np.array, rows_of(a))] == [b" " + t for t in texts]
