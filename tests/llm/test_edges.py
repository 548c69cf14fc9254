"""Nulls, empty and odd texts, repeated rows, empty tables and clashing columns, by operator,
each against a plain statement of its rule."""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
import public_tokenizers
import pytest

from lanewright.llm import (
    chat_quotes,
    decontaminate,
    exact_dedup,
    license_scan,
    ngram_join,
    piece_bpe,
    token_store,
    toxicity,
    url_filter,
    warc,
)

TEXT = " ".join(f"word{i}" for i in range(60))
NEAR = TEXT.replace("word59", "other")
DOCS = [
    (1, TEXT, "x"),
    (2, TEXT, "x"),
    (3, NEAR, None),
    (4, None, "x"),
    (5, "", "x"),
    (6, "Released under the MIT License.", "x"),
    (7, " \t\n ", "x"),
    (8, "short text", "x"),
    (9, "Short  TEXT", "x"),
    (10, "z" * 30000 + " " + "a b " * 20000, "x"),
    (5, "", "x"),
]
SCHEMA = "doc_id long, text string, n long"  # a column that operators name themselves


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(a, b, None) for a, b, _ in DOCS], SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_licenses(docs, none):
    found = license_scan.license_matches(docs).collect()
    assert [(r.doc_id, r.license_id, r.containment) for r in found] == [(6, "MIT", 1.0)]
    assert license_scan.license_matches(none).count() == 0


def test_ngram_join(docs, none):
    def grams(text):
        words = (text or "").encode().lower().split()
        if len(words) < 5:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    found = [tuple(r) for r in ngram_join.similar_components(docs).collect()]
    component = {1: 1, 2: 1, 3: 1, 9: 8}
    assert sorted(found) == sorted((d, len(grams(t)), component.get(d, d)) for d, t, _ in DOCS)
    assert ngram_join.similar_components(none).count() == 0
    assert {r.doc_id for r in ngram_join.keep_one_of_each(docs).collect()} == {1, 4, 5, 6, 7, 8, 10}


def test_toxicity(spark, docs, none):
    bad = [(i, f"a calm line {i} you m0ron {i} here", None) for i in range(100, 160)]
    good = [(i, f"a calm line {i} of plain words {i} here", None) for i in range(200, 300)]
    every = docs.unionByName(spark.createDataFrame(bad + good, SCHEMA))
    rows = [(i, 1) for i, *_ in bad] + [(i, 0) for i, *_ in good] + [(1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    found = toxicity.score_documents(every, labels).toPandas()
    assert len(found) == every.count() and found["score"].between(0, 1).all()
    assert (found["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in found["doc_id"]]).all()
    assert set(found[found["predicted"] == 1]["doc_id"]) == {i for i, *_ in bad}
    assert (toxicity.score_documents(docs, labels.limit(0)).toPandas()["score"] == 0).all()
    assert toxicity.score_documents(none, labels).count() == 0


def test_decoder_restores():
    import numpy as np

    counts = np.full((64, 64, 64), 0.1)
    text = toxicity.codes_of("  " + "you idiot loser  " * 50)
    np.add.at(counts, (text[:-2], text[1:-1], text[2:]), 1)
    decoder = toxicity.Decoder(np.log(counts / counts.sum(2, keepdims=True)))
    assert [decoder.read(w) for w in ("1d10t", "l.o.s.e.r", "loooser", "idiot")] == ["idiot", "loser", "loser", "idiot"]
    assert toxicity.spaced_runs("a l o s e r b2 c".split()) == ["aloser"]


def test_token_store(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = token_store.WordEncoder(path)
    read = token_store.read_tokens(token_store.write_tokens(docs, tokenizer_path=path, end_id=2))
    found = token_store.token_digest(read).toPandas().sort_values(["start"])
    texts = sorted((d, t) for d, t, _ in DOCS if t is not None)
    texts = sorted([*texts, (4, "")])
    ids = [[*encoder.encode([t])[0].tolist(), 2] for _, t in texts]
    assert found["doc_id"].tolist() == [d for d, _ in texts]
    assert found["n_tokens"].tolist() == [len(x) for x in ids]
    assert found["start"].tolist() == [sum(map(len, ids[:k])) for k in range(len(ids))]
    raw = [b"".join(i.to_bytes(4, "little") for i in x) for x in ids]
    assert found["ids_crc32"].tolist() == [zlib.crc32(x) for x in raw]
    empty = token_store.write_tokens(none, tokenizer_path=path, end_id=2)
    assert token_store.read_tokens(empty).count() == 0


def test_exact_dedup(docs, none):
    found = [tuple(r) for r in exact_dedup.duplicate_groups(docs).collect()]
    texts = [(d, t or "") for d, t, _ in DOCS]
    want = []
    for d, t in texts:
        same = [e for e, u in texts if u == t]
        want.append((d, max(same), len(same), d == max(same), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(found) == sorted(want)
    assert exact_dedup.duplicate_groups(none).count() == 0


def test_chat_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there\nsecond line", 0),
        (1, 1, "assistant", None, 0),
        (1, 2, "user", "> hello   THERE\n>> deeper\nmy reply", 0),
        (1, 3, "user", "> my reply\n>", 0),
        (1, 3, "user", "> my reply\n>", 0),
        (2, 0, "user", "> hello there", 0),
        (None, 0, "user", "x", 0),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key int")
    found = chat_quotes.reply_ordered(messages).collect()
    got = [(r.conv_id, r.turn, r.text, r.reply_to, r.max_level, r.n_linked) for r in found]
    assert got == [
        (None, 0, "x", None, 0, 0),
        (1, 0, "Hello there\nsecond line", None, 0, 0),
        (1, 1, "", 0, 0, 0),
        (1, 2, "my reply", 0, 2, 1),
        (1, 3, "", 2, 1, 1),
        (1, 3, "", 2, 1, 1),
        (2, 0, "", None, 1, 0),
    ]
    assert chat_quotes.reply_ordered(messages.limit(0)).count() == 0


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "http://a/", big, 0), (2, None, big, 0), (3, "u\r\nv", None, 0), (4, "u", "x" * 999, 0), (5, "u", "x" * 999, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_bytes int")
    archives = warc.write_archives(pages)
    want = [(i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h, _ in rows]
    for size in (7, 100, 1 << 20):
        found = warc.page_digest(warc.read_archives(archives, range_bytes=size)).orderBy("page_id").collect()
        assert [tuple(r[:3]) for r in found] == want
        assert [tuple(r[3:]) for r in found] == [("revisit", 2)] + [("response", None)] * 4
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_leaks(spark, docs, none):
    moved = " ".join(TEXT.split()[30:] + TEXT.split()[:30])
    items = [(1, moved), (2, TEXT.upper() + "!"), (3, "short one"), (4, None), (5, "none of these words is there at all")]
    items = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(docs, items).toPandas()
    assert set(zip(found["doc_id"], found["item_id"])) == {(d, i) for d in (1, 2, 3) for i in (1, 2)}
    assert set(found[(found["doc_id"] == 1) & (found["item_id"] == 1)]["n_tiles"]) == {2}
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert {r.doc_id for r in decontaminate.drop_leaked(docs, items).collect()} == set(range(4, 11))


def test_pieces(docs, none):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = piece_bpe.piece_digest(docs, model_path=path).toPandas().sort_values("doc_id")
    texts = [t or "" for _, t, _ in sorted(DOCS, key=lambda r: r[0])]
    ids = [library.encode(t, add_bos=True, add_eos=True) for t in texts]
    raw = [b"".join(i.to_bytes(4, "little") for i in x) for x in ids]
    assert found["ids_sha256"].tolist() == [hashlib.sha256(x).hexdigest() for x in raw]
    assert found["decoded_sha256"].tolist() == [hashlib.sha256(library.decode(x).encode()).hexdigest() for x in ids]
    assert piece_bpe.piece_digest(none, model_path=path).count() == 0


def test_urls(spark):
    rules = [url_filter.parse_rule(*r) for r in [("com/", "allow"), ("b.com/en/", "block"), ("net/es/", "block")]]
    rules = spark.createDataFrame(rules, "rule string, host string, path string, verdict string")
    urls = [None, "", "no scheme", "http://A.b.COM/en/x?q", "http://xb.com/en/", "https://y.net/es/#z", "http://net/es", "://b.com", "x://b.com/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(3, urls[3], "h")], "page_id int, url string, host string")
    found = url_filter.judge_urls(pages, rules).toPandas().sort_values("page_id")
    assert found["rule"].where(found["rule"].notna(), None).tolist() == [
        None, None, None, "b.com/en/", "b.com/en/", "com/", "net/es/", None, None, "b.com/en/",
    ]
    assert found["host"].tolist() == ["", "", "", "a.b.com", "a.b.com", "xb.com", "y.net", "net", "b.com", "b.com"]
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert set(url_filter.judge_urls(pages, rules.limit(0)).toPandas()["verdict"]) == {"allow"}
    assert isinstance(found, pd.DataFrame)
