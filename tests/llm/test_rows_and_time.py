"""Repeated and null ids row by row, and texts that once took time beyond their length."""

from __future__ import annotations

import random
import re
import time

import pytest

from lanewright.llm import chat_quotes, decontaminate, exact_dedup, ngram_join, toxicity

SCHEMA = "doc_id long, text string, __row string, n long"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, "own", k) for k, (d, t) in enumerate(rows)], SCHEMA)


def _kept(df):
    assert df.columns == ["doc_id", "text", "n"]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_exact_copies_by_row(spark):
    rows = [(5, "same"), (7, "same"), (5, "only one"), (9, "twin"), (9, "twin"), (None, "same"), (None, "lone")]
    docs = _docs(spark, rows).drop("__row")
    assert _kept(exact_dedup.drop_duplicates(docs)) == sorted(
        [(7, "same"), (5, "only one"), (9, "twin"), (None, "lone")], key=repr
    )
    unique = _docs(spark, [(1, "a"), (2, "a"), (3, None), (4, "")]).drop("__row")
    assert _kept(exact_dedup.drop_duplicates(unique)) == [(2, "a"), (4, "")]
    assert exact_dedup.drop_duplicates(docs.limit(0)).count() == 0


A = " ".join(f"a{k}" for k in range(60))
B = " ".join(f"b{k}" for k in range(60))


def _near(text):
    return text + " more"


def test_near_copies_by_row(spark):
    rows = [(5, A), (5, B), (6, _near(A)), (7, _near(B)), (None, _near(A)), (None, "other words"), (8, A)]
    docs = _docs(spark, rows).drop("__row")
    found = sorted(((r.doc_id, r.component_id) for r in ngram_join.similar_components(docs).collect()), key=repr)
    assert found == sorted([(5, 5), (5, 5), (6, 5), (7, 5), (None, 5), (None, None), (8, 5)], key=repr)
    kept = _kept(ngram_join.keep_one_of_each(docs))
    assert kept == sorted([(5, A), (5, B), (None, "other words")], key=repr)


def test_leaks_by_row(spark):
    items = spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(20)))], "item_id long, text string")
    rows = [(5, "start " + items.first().text + " end"), (5, A), (None, items.first().text), (None, B), (6, None)]
    docs = _docs(spark, rows).drop("__row")
    assert _kept(decontaminate.drop_leaked(docs, items)) == sorted([(5, A), (None, B), (6, None)], key=repr)
    assert decontaminate.drop_leaked(docs.limit(0), items).columns == docs.columns


def test_toxic_by_row(spark):
    bad = [(i, f"a calm line {i} you m0ron {i} here") for i in range(100, 160)]
    good = [(i, f"a calm line {i} of plain words {i} here") for i in range(200, 300)]
    odd = [(5, "you moron"), (5, "plain words"), (None, "you moron"), (None, "plain words")]
    docs = _docs(spark, bad + good + odd).drop("__row")
    labels = spark.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good], "doc_id long, toxic int")
    kept = _kept(toxicity.drop_toxic(docs, labels))
    assert kept == sorted([*good, (5, "plain words"), (None, "plain words")], key=repr)
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0


def test_components_that_need_many_rounds(spark):
    from lanewright.llm.common import connected_components, stage

    edges = spark.createDataFrame([(k, k + 1) for k in range(400)], "a long, b long")
    found = connected_components(stage(spark, "chain"), edges, "chain").collect()
    assert {r.component for r in found} == {0} and len(found) == 401


# The pattern that stood for ``gapped`` before, right but cubic.
_OLD = re.compile(
    rf"^(?=.*{toxicity._LETTER})\W*?{toxicity._EITHER}"
    rf"(?:[{re.escape(toxicity._GAPS)}]+{toxicity._EITHER}){{2,}}\W*$"
)


def test_gapped_words_as_before():
    rng = random.Random(5)
    letters = "ab.-_!$(<%1 0\"?,é"
    for _ in range(60_000):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))).replace(" ", "")
        assert toxicity.gapped(word) == bool(_OLD.search(word)), word


@pytest.mark.parametrize("part", ["!.", "$,", "%-", "a.", "a..", "1.", "!!a.", "((", "_.", "."])
def test_long_words_take_time_by_their_length(part):
    for word in (part * 50_000 + "ab", "x" + part * 50_000, part * 50_000 + '"'):
        start = time.perf_counter()
        toxicity.traced(word), toxicity._SLIGHT.search(word), toxicity.signs(word)
        assert time.perf_counter() - start < 2


def test_long_words_are_scored(spark):
    import numpy as np

    scorer = toxicity.Scorer({"moron": 4.0}, np.zeros((64, 64, 64)))
    start = time.perf_counter()
    scorer.evidence("!." * 20_000 + "ab " + "m.o.r.o.n " + "a." * 20_000)
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("text", ["\n" * 200_000, "\r" * 200_000, "\n \t" * 60_000, "x\n" * 100_000])
def test_messages_of_blank_lines(spark, text):
    messages = spark.createDataFrame([(1, 0, "u", text), (1, 1, "u", text + "> a")], "conv_id long, turn long, role string, text string")
    start = time.perf_counter()
    assert chat_quotes.reply_ordered(messages).count() == 2
    messages.filter(messages.text.rlike(chat_quotes.HAS_QUOTE)).count()
    assert time.perf_counter() - start < 30


def test_quote_lines_as_before(spark):
    texts = [">a", "a\n> b", "a\n\n \t>b", "a > b", "a\r\n>b", "\x0b>a", "a\n b>", "", "\n", ">", "a\n\x0c >"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(df.t.rlike(chat_quotes.HAS_QUOTE).alias("a"), df.t.rlike(r"(?m)^\s*>").alias("b")).collect()
    assert all(r.a == r.b for r in found)


def test_words_that_cannot_hold_a_weighted_one_need_no_decoding():
    import numpy as np

    rng = random.Random(11)
    model = np.random.default_rng(2).normal(-3, 1, (64, 64, 64))
    weights = {"moron": 4.0, "loser": 3.0, "ass": 2.5, "idio*": 3.5, "stup*": 2.2, "taxi": 2.1, "b4d": 2.3}
    scorer, plainly = (toxicity.Scorer(weights, model) for _ in range(2))
    plainly.reachable = lambda word: True
    base = ["moron", "loser", "ass", "idiot", "stupid", "taxi", "b4d", "calm", "lossy", "bill", "mass", "class"]
    swap = {"o": "0", "i": "1!|", "l": "1|", "e": "3", "a": "4@", "s": "5$", "t": "7+", "b": "8", "d": "d"}
    for _ in range(4000):
        letters = []
        for c in rng.choice(base) + rng.choice(["", "", rng.choice(base)]):
            c = rng.choice(swap[c]) if c in swap and rng.random() < 0.3 else c
            letters += [c] * rng.choice([1, 1, 1, 2, 3]) + [rng.choice(".-_ *!(")] * (rng.random() < 0.2)
        text = "".join(letters)
        assert scorer.evidence(text) == plainly.evidence(text), text
        for word in text.split():
            assert scorer.weight(word) == plainly.weight(word), word
