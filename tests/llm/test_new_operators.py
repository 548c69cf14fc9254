"""Collocations, byte-level BPE and hard negatives against plain statements of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lanewright.llm import blocks, byte_bpe, collocations, hard_negatives
from test_encoders import odd_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, lang string, text string, word string, block long, f int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


# Byte-level BPE


def test_splitter_and_merges_equal_the_library(library):
    split, merges = byte_bpe.Splitter(library), byte_bpe.Merges(BYTES)
    rng = random.Random(3)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = [t for t in odd_texts() if t] + ["it's we'll I'VE don't 've", "a\x1cb\x1d \x85 \xa0x　  y"]
    texts += ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext", " \n<|endoftext|> \n"]
    texts += ["".join(chr(rng.choice(points)) if rng.random() < 0.3 else rng.choice(" ab1'!\n\t")
                      for _ in range(60)) for _ in range(1500)]
    for text in texts:
        mine = [i for w in split(text) for i in merges.encode(w)]
        assert mine == library.encode(text, add_special_tokens=False).ids
        decoded = b"".join(merges.pieces[i] for i in mine).decode("utf-8", "replace")
        assert decoded == library.decode(mine, skip_special_tokens=False)


def test_every_character_is_split_as_by_the_library(library):
    split = byte_bpe.Splitter(library)
    for a in range(0, 0x110000, 64):
        points = [chr(c) for c in range(a, a + 64) if not 0xD800 <= c <= 0xDFFF]
        text = " ".join(f"a{c}1{c}!{c}" for c in points)
        theirs = [text[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert split(text) == theirs


def test_long_words_merge_as_short_ones(library, monkeypatch):
    merges, rng = byte_bpe.Merges(BYTES), random.Random(0)
    words = ["".join(rng.choice("abcdeth") for _ in range(n)) for n in (49, 200, 999)]
    for word in [*words, "z" * 30000]:
        assert merges.encode(word) == library.encode(word, add_special_tokens=False).ids
    monkeypatch.setattr(byte_bpe, "SHORT", 0)
    for word in ["a", "the", "antidisestablishment", "é" * 9]:
        assert merges.encode(word) == library.encode(word, add_special_tokens=False).ids


@pytest.fixture
def odd_docs(spark):
    texts = [*odd_texts()[:400], None, "", " ", "same", "same", "x" * 20000, "<|endoftext|> y"]
    rows = [(k, None, t, "w", 3, None) for k, t in enumerate(texts)]
    rows += [(None, "en", "no id", None, None, 1), (3, "en", "again 3", None, None, 1)]
    return spark.createDataFrame(rows, DOCS)


def _encoded(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_byte_bpe_documents(odd_docs, library, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 2_000)
    docs = odd_docs.repartition(3)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = byte_bpe.encode_documents(docs, tokenizer_path=BYTES).collect()
    wanted = [(d, *_encoded(library, t)) for d, t in texts]
    assert sorted(map(repr, ((r.doc_id, r.ids, r.decoded) for r in found))) == sorted(map(repr, wanted))
    digest = byte_bpe.encoding_digest(docs, tokenizer_path=BYTES).collect()
    wanted = [
        (d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
         hashlib.sha256(t.encode()).hexdigest()) for d, i, t in wanted
    ]
    assert sorted(map(repr, map(tuple, digest))) == sorted(map(repr, wanted))


def test_byte_bpe_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert byte_bpe.encoding_digest(none, tokenizer_path=BYTES).count() == 0
    empty = spark.createDataFrame([(1, None, "", None, None, None)] * 2, DOCS)
    assert [r.n_tokens for r in byte_bpe.encoding_digest(empty, tokenizer_path=BYTES).collect()] == [0, 0]


def test_word_table_past_its_bound(odd_docs, library, monkeypatch):
    table = byte_bpe._WordTable(byte_bpe.Merges(BYTES))
    monkeypatch.setattr(byte_bpe, "MOST_WORDS", 3)
    for word in [b"the", b" a", b"x", b"yy", b"the", b"zzz"]:
        ids = library.encode(word.decode(), add_special_tokens=False).ids
        assert np.frombuffer(table[word], "<u4").tolist() == ids
        assert len(table) <= 3


def test_decode_by_join(spark, library):
    rows = [(k, library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(odd_texts()[:300])]
    rows += [(900, []), (901, [220, 50256, 94, 199]), (901, [94])]
    df = spark.createDataFrame([*rows, (902, None)], "doc_id long, ids array<int>")
    found = byte_bpe.decode_documents(df, tokenizer_path=BYTES).collect()
    wanted = [(d, library.decode(i, skip_special_tokens=False)) for d, i in rows] + [(902, "")]
    assert sorted(map(tuple, found)) == sorted(wanted)


# Collocations


def _collocations(rows, least, percent=80, top=2000):
    counts, n = {}, Counter()
    for _, lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    key = (lang, tuple(words[k : k + size]))
                    counts[key] = counts.get(key, 0) + 1
    out = {}
    frequent = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    most = Counter()
    for (lang, words), f in frequent.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                inner = (lang, words[k : k + size])
                most[inner] = max(most[inner], f)
    for (lang, words), a in frequent.items():
        if 100 * most[lang, words] >= percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def _prose(rng, n):
    words = ["the", "Of", "new", "york", "city", "a", "A", "état", "b-c", "ÉTAT", "日本"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\xa0", " ! "]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))


@pytest.fixture
def prose():
    rng = random.Random(7)
    rows = [(k, rng.choice(["en", "de", None, ""]), _prose(rng, rng.randint(0, 300)), "w", 1, 2) for k in range(60)]
    rows += [(1, "en", "new york city", None, 1, 2)] * 40  # repeated rows
    rows += [(70, "en", None, None, 1, 2), (71, "fr", "", None, 1, 2), (None, None, "of the", "", 1, 2)]
    rows += [(72, "en", "a " * 5000 + "the.", None, 1, 2), (73, "xx", "one word", None, 1, 2)]
    return rows


@pytest.mark.parametrize("shard, buckets, chars", [(200_000, 4, 32_000_000), (40, 9, 3_000)])
def test_collocations(spark, prose, monkeypatch, shard, buckets, chars):
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "BUCKETS_EACH", buckets)
    monkeypatch.setattr(blocks, "BLOCK_CHARS", chars)
    df = spark.createDataFrame(prose, DOCS).repartition(3)
    for least, top in ((30, 2000), (4, 25)):
        found = collocations.collocations(df, least=least, top=top).collect()
        assert sorted(map(tuple, found)) == _collocations(prose, least, top=top)
        assert len(found) > 2


def test_collocations_of_nothing(spark):
    for rows in ([], [(1, None, None, None, None, None)], [(1, "en", "one two", None, None, None)] * 29):
        assert collocations.collocations(spark.createDataFrame(rows, DOCS)).count() == 0


# Hard negatives


def _hard_negatives(rows, is_anchor, top=5, percent=80):
    ok = [
        (k, i, label, [math.floor(256 * np.float64(x)) for x in v])
        for k, (i, v, label, *_) in enumerate(rows)
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, anchor, label, v in ok:
        if not is_anchor(anchor):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, j, other) for j, i, other, w in ok if j != k
        )
        for score, positive, _, other in [s for s in scored if s[3] == label][:top]:
            near = [s for s in scored if s[3] != label and -percent * score <= -100 * s[0] <= -100 * score]
            for rank, s in enumerate(near[:top], 1):
                out.append((anchor, positive, rank, s[1], -score, -s[0]))
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, row long, score string"


def _vectors(rng, n, dims, scale):
    base = [[rng.gauss(0.1, scale) for _ in range(dims)] for _ in range(6)]
    rows = []
    for k in range(n):
        v = [x + rng.gauss(0, scale / 3) for x in rng.choice(base)]
        rows.append((k, [float(np.float32(x)) for x in v], rng.randrange(3), 9, None))
    return rows


@pytest.mark.parametrize("dims, scale", [(64, 0.1), (13, 1.0), (8, 1e6), (3, 3e6), (5, 1e16)])
def test_hard_negatives(spark, monkeypatch, dims, scale):
    rng = random.Random(dims)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_ROWS", 17)
    monkeypatch.setattr(hard_negatives, "STEP", 5)
    rows = _vectors(rng, 120, dims, scale)
    small = [min(1.0, scale)] * dims
    rows += [(10, rows[10][1], rows[10][2], 9, None)] * 2 + [(11, rows[4][1], rows[4][2], 9, None)] * 9
    rows += [(None, small, 1, 9, None), (121, small, None, 9, None), (122, None, 1, 9, None)]
    rows += [(123, [None] * dims, 1, 9, None), (124, [float("nan")] * dims, 1, 9, None)]
    rows += [(125, [float("-inf")] * dims, 2, 9, None), (130, [], 1, 9, None), (131, small[:2], 2, 9, None)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    wanted = _hard_negatives(rows, lambda i: i % 10 == 0)
    if scale > 1e15:  # the scores themselves leave 64 bits
        assert max(abs(w[4]) for w in wanted) >= 1 << 63
        with pytest.raises(NumberFormatException):
            hard_negatives.hard_negatives(df, is_anchor=F.col("vec_id") % 10 == 0)
    else:
        found = hard_negatives.hard_negatives(df, is_anchor=F.col("vec_id") % 10 == 0)
        assert sorted(map(tuple, found.collect())) == wanted
        assert len(wanted) > 50


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none, is_anchor=F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0, 2.0], 1, 1, None), (11, [1.0, 2.0], 2, 1, None)], VECTORS)
    assert hard_negatives.hard_negatives(alone, is_anchor=F.col("vec_id") % 10 == 0).count() == 0


def test_subset_sums_score_exactly():
    rng = np.random.default_rng(1)
    for low, high in ((-256, 256), (0, 1), (-(1 << 20), 1 << 20), (-1, 0)):
        a, c = rng.integers(low, high, (7, 21)), rng.integers(low, high, (33, 21))
        found = hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(c))
        assert (found == c @ a.T).all()
