"""Cases of the second review, each of which an earlier version got wrong."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewright.llm import chat_quotes, decontaminate, ngram_join, toxicity, url_filter


@pytest.fixture(scope="module")
def scorer():
    counts = np.full((64, 64, 64), 0.1)
    text = toxicity.codes_of("  " + "you are a stupid idiot and a loser to assist in class  " * 50)
    np.add.at(counts, (text[:-2], text[1:-1], text[2:]), 1)
    model = np.log(counts / counts.sum(2, keepdims=True))
    return toxicity.Scorer({"idiot": 7.0, "stupid": 6.0, "loser": 5.0}, model)


@pytest.mark.parametrize(
    "text, weights",
    [
        ("you are a l o s e r", [5.0]),
        ("s t u p i d i d i o t", [6.0, 7.0]),
        ("y o u i d i o t", [7.0]),
        ("you id iot", [7.0]),
        ("1d iot", [7.0]),
        ("1.d.1.0.t", [7.0]),
        ("l.0.s.3.r", [5.0]),
        ("id-iot", [7.0]),
        ("looser", [5.0]),
        ("you.idiot", [7.0]),
        ("to assist in class", []),
        ("t o a s s i s t", []),
        ("3.14 2020-01-01", []),
    ],
)
def test_every_spelling_is_scored(scorer, text, weights):
    assert scorer.evidence(text)[2] == sum(weights)


def _replies(spark, texts):
    rows = [(1, i, "user", t) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r.turn: (r.reply_to, r.n_linked) for r in chat_quotes.reply_ordered(messages).collect()}


def test_a_message_answers_the_last_turn_there_is(spark):
    many = [3000 + 7 * k for k in range(400)]
    turns = {1: [0, 5, 6, 2050, 2050], 2: [3], 3: [-4, -1, 0, 1], None: [0, 2], 4: many, 5: [None, 1]}
    rows = [(c, t, "user", "x") for c, ts in turns.items() for t in ts]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn, r.reply_to) for r in chat_quotes.reply_ordered(messages).collect()}
    want = set()
    for c, ts in turns.items():
        for t in ts:
            earlier = [u for u in ts if t is not None and u is not None and u < t]
            want.add((c, t, max(earlier, default=None)))
    assert found == want
    assert chat_quotes.reply_ordered(messages).count() == len(rows)


def test_the_shallowest_quote_decides(spark):
    first = "one line here\nanother line here\nthird line here"
    second = "".join(f"> {x}\n" for x in first.split("\n")) + "my own line"
    third = "> my own line\n" + "".join(f">> {x}\n" for x in first.split("\n")) + "agreed"
    assert _replies(spark, [first, second, third]) == {0: (None, 0), 1: (0, 3), 2: (1, 4)}


def test_quotes_wrapped_again_or_cut_link(spark):
    first = "\n".join(" ".join(f"word{k}" for k in range(a, a + 10)) for a in (0, 10, 20))
    words = first.split()
    wrapped = "\n".join("> " + " ".join(words[a : a + 7]) for a in range(0, 30, 7))
    cut = "\n".join("> " + " ".join(words[a : a + 7]) for a in range(6, 27, 7))
    found = _replies(spark, [first, "nothing of it", wrapped, cut + "\nso"])
    assert found == {0: (None, 0), 1: (0, 0), 2: (0, 5), 3: (0, 3)}


def test_a_repeated_line_links_to_the_nearest_or_the_whole(spark):
    found = _replies(spark, ["yes", "no", "yes", "other", "> yes"])
    assert found[4] == (2, 1)
    found = _replies(spark, ["a long first line\nshort", "a long first line", "x", "> a long first line\n> short"])
    assert found[3] == (0, 2)


def test_an_item_that_repeats_itself_is_found(spark):
    item = " ".join(["one two three four five"] * 20)
    docs = spark.createDataFrame([(1, item), (2, "one two three four five and no more")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.covered_words) for r in found] == [(1, 7, 100)]


@pytest.fixture(scope="module")
def smallest(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark")]


def test_ngram_join_by_brute_force(smallest):
    docs = [(r.doc_id, (r.text or "").encode().lower().split()) for r in smallest[0].collect()]
    sets = {}
    for d, words in docs:
        last = max(1, len(words) - 4) if words else 0
        sets[d] = {tuple(words[i : i + 5]) for i in range(last)}
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    want = {(d, len(sets[d]), root(d)) for d in ids}
    assert {tuple(r) for r in ngram_join.similar_components(smallest[0]).collect()} == want


def test_leaks_by_brute_force(smallest):
    hashes = decontaminate.StrippedHashes()
    items = [(r.item_id, hashes.of(r.text)) for r in smallest[1].collect() if r.text]
    want = set()
    for r in smallest[0].collect():
        words = hashes.of(r.text)
        own = set(words.tolist())
        for item, wanted in items:
            # Covered words stand in the document.
            if 2 * sum(w in own for w in wanted.tolist()) < len(wanted):
                continue
            covered = sum(t[2] for t in decontaminate.tiles(words, wanted))
            if covered and 2 * covered >= len(wanted):
                want.add((r.doc_id, item, covered))
    found = decontaminate.leaks(*smallest).collect()
    assert want and {(r.doc_id, r.item_id, r.covered_words) for r in found} == want


def test_a_long_list_of_urls_has_a_filter_of_its_size(spark):
    assert [url_filter.block_bits_for(n) for n in (0, 5, 65_536, 65_537, 10**6, 10**9)] == [14, 14, 14, 15, 18, 18]
    n = 150_000
    key = F.col("id").cast("string")
    rules = spark.range(n).select(
        F.concat(F.lit("s"), key, F.lit(".org/a/")).alias("rule"),
        F.concat(F.lit("s"), key, F.lit(".org")).alias("host"),
        F.lit("/a/").alias("path"),
        F.lit("block").alias("verdict"),
    )
    url = F.concat(F.lit("http://W.s"), (F.col("id") * 11).cast("string"), F.lit(".org/a/x"))
    pages = spark.range(40_000).select(F.col("id").alias("page_id"), url.alias("url"))
    judged = url_filter.judge_urls(pages, rules)
    wrong = judged.filter((F.col("page_id") * 11 < n) != F.coalesce(F.col("verdict") == "block", F.lit(False)))
    assert judged.count() == 40_000 and wrong.count() == 0
    named = F.concat(F.lit("s"), (F.col("page_id") * 11).cast("string"), F.lit(".org/a/"))
    assert judged.filter(F.col("rule") == named).count() == len(range(0, n, 11))
    blocks = url_filter.bloom_blocks(rules.select(F.concat_ws(url_filter.SEPARATOR, "host", "path").alias("key")), 16)
    others = spark.range(20_000).select(F.concat(F.lit("none"), key).alias("key"))
    assert others.filter(url_filter._might_contain(F.col("key"), blocks, 16)).count() < 400
