"""Benchmark passages in documents, by greedy string tiling.

1. Every run of SEED words of a benchmark item is a seed. A Bloom filter of the
   seeds, of a fixed size, tells which documents can hold one; only they go on.
2. Their possible seeds are joined to the items by equality. An item goes on
   for a document if the seeds they share could cover enough of it.
3. Greedy string tiling: running Karp-Rabin hashes find the longest stretch
   that document and item share outside earlier tiles; it is checked word by
   word, marked in both, and the search goes on until none of SEED words is
   left. Tiles may lie in any order, so moved passages count.
4. An item counts as leaked if its tiles cover ``threshold`` of its words.

Words are lower-cased (A-Z) and stripped of punctuation at their ends.

Defined cases: null and empty texts match nothing; items of fewer than SEED
words match nothing; items with equal texts are each reported; repeated rows of
a document give one row for each item; an empty table on either side gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import (
    CACHE_WORDS,
    as_long,
    ascii_words,
    mix64,
    shingle_hashes,
    stage,
    text_chunks,
    without_rows,
)

SEED = 5
THRESHOLD = 0.5
FILTER_BITS = 23  # 1 MB, whatever the benchmark's size
_EDGE = b".,;:!?\"'()[]{}<>*_-"


class StrippedHashes(dict):
    """Word to the hash of the word without punctuation at its ends."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.strip(_EDGE))
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = ascii_words(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _seeds(words: np.ndarray) -> np.ndarray:
    return shingle_hashes(words, SEED) if len(words) >= SEED else words[:0]


def _probes(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return seeds & mask, mix64(seeds) >> np.uint64(64 - FILTER_BITS)


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = StrippedHashes()
    for pdf in batches:
        rows = []
        for item, text in zip(pdf["item_id"], pdf["text"]):
            words = hashes.of(text)
            own, times = np.unique(_seeds(words), return_counts=True)
            rows.extend((item, s, n, len(words)) for s, n in zip(as_long(own), times))
        yield pd.DataFrame(rows, columns=["item_id", "seed", "times", "n_words"])


def _possible(bitmap):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, hashes = np.unpackbits(bitmap.value, bitorder="little").view(bool), StrippedHashes()
        for batch in batches:
            for pdf in text_chunks(batch):
                rows = []
                for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                    seeds = _seeds(hashes.of(text))
                    a, b = _probes(seeds)
                    hit = bits[a] & bits[b]
                    if hit.any():
                        rows.append((doc_id, text, as_long(np.unique(seeds[hit]))))
                yield pd.DataFrame(rows, columns=["doc_id", "text", "seeds"])

    return run


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Rolling:
    """Karp-Rabin hashes of all stretches of a length, from running sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words, self.free = words, np.ones(n, bool)
        power = np.cumprod(np.full(n, _BASE))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * power)])
        self.lift = power[::-1]  # brings stretches to one power

    def stretches(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of stretches outside tiles, and their hashes."""
        n = len(self.words) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        marked = np.concatenate([[0], np.cumsum(~self.free)])
        starts = np.flatnonzero(marked[size:] == marked[:-size])
        return starts, (self.sums[starts + size] - self.sums[starts]) * self.lift[starts]


def _shared_stretch(a: Rolling, b: Rolling, scale: np.uint64, size: int) -> tuple[int, int] | None:
    """Leftmost stretch of ``b`` of this size that ``a`` also has, checked by words."""
    at_a, in_a = a.stretches(size)
    at_b, in_b = b.stretches(size)
    if not len(at_a) or not len(at_b):
        return None
    in_b = in_b * scale  # both at the power of the longer side
    order = np.argsort(in_a, kind="stable")
    found = np.searchsorted(in_a[order], in_b)
    found = np.minimum(found, len(order) - 1)
    for k in np.flatnonzero(in_a[order[found]] == in_b):
        i, j = int(at_a[order[found[k]]]), int(at_b[k])
        if np.array_equal(a.words[i : i + size], b.words[j : j + size]):
            return i, j
    return None


def tiles(document: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(document start, item start, words)``, longest first."""
    a, b = Rolling(document), Rolling(item)
    # lift brings a stretch to the power of its own side's end; level the two sides.
    gap = len(document) - len(item)
    if gap >= 0:
        lift_a, lift_b = np.uint64(1), np.uint64(pow(int(_BASE), gap, 1 << 64))
    else:
        lift_a, lift_b = np.uint64(pow(int(_BASE), -gap, 1 << 64)), np.uint64(1)
    a.lift = a.lift * lift_a
    out, longest = [], min(len(document), len(item))
    while longest >= least:
        low, high, best = least, longest, None
        # A longest stretch contains shared stretches of every smaller size.
        while low <= high:
            size = (low + high + 1) // 2 if best else low
            place = _shared_stretch(a, b, lift_b, size)
            if place is None:
                high = size - 1
            else:
                best, low = (*place, size), size + 1
        if best is None:
            return out
        i, j, longest = best
        a.free[i : i + longest] = False
        b.free[j : j + longest] = False
        out.append(best)
    return out


def _tile_rows(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = StrippedHashes()
        for pdf in batches:
            rows = []
            for doc_id, text, items in zip(pdf["doc_id"], pdf["text"], pdf["items"]):
                words = hashes.of(text)
                for item in items:
                    wanted = hashes.of(item["text"])
                    found = tiles(words, wanted)
                    covered = sum(t[2] for t in found)
                    if covered >= threshold * len(wanted):
                        longest = max(t[2] for t in found)
                        share = covered / len(wanted)
                        rows.append((doc_id, item["item_id"], len(wanted), covered, share, len(found), longest))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _LEAK.split(", ")])

    return run


_LEAK = (
    "doc_id long, item_id long, item_words long, covered_words long, coverage double, "
    "n_tiles long, longest_tile long"
)


def leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id`` with coverage and tiles, for every leaked item of a document."""
    spark = docs.sparkSession
    work = stage(spark, "leaks")
    items = benchmark.select("item_id", "text").dropna(subset=["text"])
    seeds = work.cut(
        items.mapInPandas(_item_seeds, "item_id long, seed long, times long, n_words long"), "seeds"
    )
    # The filter's set bits: at most 2**FILTER_BITS places, however many seeds.
    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = _probes(pdf["seed"].to_numpy(np.int64).view(np.uint64))
            yield pd.DataFrame({"place": np.unique(np.concatenate([a, b]).astype(np.int64))})

    set_bits = seeds.select("seed").mapInPandas(places, "place long").distinct().toPandas()
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    bits[set_bits["place"].to_numpy(np.int64)] = 1
    bitmap = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little"))
    possible = work.cut(
        docs.select("doc_id", "text").mapInPandas(
            _possible(bitmap), "doc_id long, text string, seeds array<long>"
        ),
        "possible",
    )
    # Places of the item, so one that repeats itself is not undercounted.
    enough = F.lit(SEED) * F.col("n_seeds") >= F.lit(threshold) * F.col("n_words")
    pairs = (
        possible.select("doc_id", F.explode("seeds").alias("seed"))
        .distinct()
        .join(seeds, "seed")
        .groupBy("doc_id", "item_id")
        .agg(F.sum("times").alias("n_seeds"), F.first("n_words").alias("n_words"))
        .filter(enough)
    )
    wanted = (
        pairs.join(items, "item_id")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("item_id", "text")).alias("items"))
    )
    found = possible.select("doc_id", "text").join(wanted, "doc_id")
    found = found.mapInPandas(_tile_rows(threshold), _LEAK)
    best = F.max(F.struct("covered_words", "item_words", "coverage", "n_tiles", "longest_tile"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    work = stage(docs.sparkSession, "leaks-drop")

    def leaked(rows: DataFrame) -> DataFrame:
        return leaks(rows, benchmark, threshold=threshold).select("doc_id").distinct()

    return without_rows(docs, work, leaked)
