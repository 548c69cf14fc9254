"""Collocations by the stripes pattern.

A stripe belongs to a prefix, a phrase of one to three words, and counts the
words that follow it. Stripes of all blocks of documents meet by prefix and are
added word by word. The sum gives the extensions of the prefix with their
counts, which are the totals of the prefixes one word longer, and the largest
count that a longer phrase around a phrase has.

Words that occur too seldom cannot be in a frequent phrase, nor can a phrase
with a seldom part. So counting goes level by level: what is frequent comes back
to the blocks that have it, and only two frequent phrases side by side, one word
apart, are extended. This leaves out no frequent phrase and changes no count.

A stripe is cut into shards by a hash of the next word, as many as the total of
its prefix asks for, so one very common prefix is the work of many tasks. Shards
travel in buckets by a hash of prefix and shard: a block packs what it has for a
bucket into one row, and a task adds up one bucket at a time.

Defined cases: null and empty texts have no words; a null lang counts as
``und``; a text of any length is read whole; equal and null doc_ids are rows of
their own, doc_id is not read; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.blocks import WORD_BITS, binaries, in_blocks, load, pack, save, unpack
from lanewright.llm.common import mix64, stage
from lanewright.sources.staging import Stage

LONGEST = 4
# Occurrences of a prefix that one shard of its stripe covers.
SHARD = 200_000
# Buckets a shuffle partition is cut into; one bucket is held in memory.
BUCKETS_EACH = 4

# Splits of the texts: A-Z lowered, tabs as spaces, the marks that end a piece as line feeds.
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_UPPER + b"\t" + _ENDS, _LOWER + b" " + b"\n" * len(_ENDS))


class _Words(dict):
    """Words of one language to their numbers; those of a block count up together."""

    def __init__(self, words: list[tuple[str, bytes]], lang: str):
        super().__init__({b"": -1, b"\n": 0})
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        number = self[word] = len(self.words)
        return number


def _coded(docs: DataFrame, folder: str) -> DataFrame:
    """``block, uri`` once a block; ``block, unit, lang, word, n`` once a distinct word of it."""
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("uri", pa.string()),
            ("unit", pa.int32()),
            ("lang", pa.string()),
            ("word", pa.string()),
            ("n", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"words": [], "of": {}, "codes": []}

        def add(lang, text) -> None:
            of = state["of"].get(lang)
            if of is None:
                of = state["of"][lang] = _Words(state["words"], lang)
            parts = text.encode().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
            parts.append(b"\n")
            codes = np.fromiter(map(of.__getitem__, parts), np.int32, len(parts))
            state["codes"].append(codes[codes >= 0])

        def close(block: int) -> Iterator[pa.RecordBatch]:
            words, units = state["words"], np.concatenate(state["codes"])
            state.update(words=[], of={}, codes=[])
            if not words:
                return
            n = np.bincount(units, minlength=len(words) + 1)
            rows = [[block], [save(folder, {"unit": units})], [0], [None], [None], [0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(rows, schema)], schema=schema
            )
            for a in range(0, len(words), 100_000):
                part = words[a : a + 100_000]
                units_ = np.arange(a + 1, a + 1 + len(part), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), block)),
                        pa.nulls(len(part), pa.string()),
                        pa.array(units_),
                        pa.array([lang for lang, _ in part], pa.string()),
                        pa.array([word for _, word in part], pa.binary()).cast(pa.string()),
                        pa.array(n[units_]),
                    ],
                    schema=schema,
                )

        yield from in_blocks(batches, add, close, lambda _, text: len(text))

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return texts.mapInArrow(
        run, "block long, uri string, unit int, lang string, word string, n long"
    )


def _keys(column: pa.ChunkedArray, words: int) -> np.ndarray:
    """Ids of the words of each phrase, ``[phrase, word]``."""
    return np.frombuffer(b"".join(column.to_pylist()), ">i8").reshape(-1, words).astype(np.int64)


def _key_column(words: np.ndarray) -> pa.Array:
    """Phrases as binary values: the ids of their words, eight bytes each."""
    ends = np.arange(1, len(words) + 1, dtype=np.int64) * 8 * words.shape[1]
    return binaries(np.ascontiguousarray(words).astype(">i8").tobytes(), ends)


_STRIPES = pa.schema(
    [
        ("block", pa.int64()),
        ("uri", pa.string()),
        ("bucket", pa.int32()),
        ("first", pa.int32()),
        ("stripes", pa.binary()),
    ]
)


def _bucket(prefix: np.ndarray, shard: np.ndarray, buckets: int) -> np.ndarray:
    value = shard.astype(np.uint64)
    for word in prefix.T:
        value = mix64(value * np.uint64(31) + word.astype(np.uint64))
    return (value % np.uint64(buckets)).astype(np.int64)


def _extend(
    blocks: DataFrame, units: DataFrame, words: int, folder: str, buckets: int
) -> DataFrame:
    """Stripes of every block whose prefixes have ``words`` words.

    ``blocks`` has ``block, uri``: the unit at each place. ``units`` has ``block,
    unit, key, f`` of the frequent ones, or ``block, members`` with many packed
    together. Gives ``block, uri`` with the new units and, for each bucket, its
    stripes, packed; the new units count up from ``first`` in the order of their
    entries.
    """

    def run(key, block: pa.Table, units_: pa.Table) -> pa.Table:
        if not units_.num_rows or not block.num_rows:
            return _STRIPES.empty_table()
        numbers, keys, total = _units(units_, words)
        m = len(numbers)
        at = load(block["uri"][0].as_py())["unit"]
        dense = np.zeros(max(int(at.max(initial=0)), int(numbers.max())) + 1, np.int64)
        dense[numbers] = np.arange(1, m + 1)
        at = dense[at]
        # One gap is as good as many.
        at = at[np.append(True, (at[1:] > 0) | (at[:-1] > 0))]
        here = np.flatnonzero((at[:-1] > 0) & (at[1:] > 0))
        if not len(here):
            return _STRIPES.empty_table()
        pairs, which, n = np.unique(
            (at[here] - 1) * m + at[here + 1] - 1, return_inverse=True, return_counts=True
        )
        left, follows = pairs // m, keys[pairs % m, words - 1]
        shards = (1 + total[left] // SHARD).astype(np.uint64)
        shard = (mix64(follows.astype(np.uint64)) % shards).astype(np.int32)
        bucket = _bucket(keys[left], shard, buckets)
        order = np.lexsort((shard, left, bucket))
        left, shard, follows, n = left[order], shard[order], follows[order], n[order]
        bucket = bucket[order]
        uri = None
        if words < LONGEST - 1:
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(1, len(order) + 1)
            place = np.zeros(len(at), np.int32)
            place[here] = number[which]
            uri = save(folder, {"unit": place})
        own = block["block"][0].as_py()
        rows = [(own, uri, None, None, None)]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            change = (left[a + 1 : b] != left[a : b - 1]) | (shard[a + 1 : b] != shard[a : b - 1])
            starts = np.flatnonzero(np.append(True, change))
            packed = pack(
                {
                    "prefix": keys[left[a + starts]].ravel(),
                    "shard": shard[a + starts],
                    "size": np.diff(np.append(starts, b - a)).astype(np.int32),
                    "next": follows[a:b],
                    "n": n[a:b].astype(np.int32),
                }
            )
            rows.append((own, None, int(bucket[a]), a + 1, packed))
        return pa.Table.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*rows), _STRIPES)], schema=_STRIPES
        )

    schema = "block long, uri string, bucket int, first int, stripes binary"
    others = [c for c in units.columns if c != "block"]
    own = units.select(F.col("block").alias("of_block"), *others)
    # The rows are few and small for the work they stand for, so the tasks are counted.
    n_tasks = buckets // BUCKETS_EACH
    mine, found = blocks.repartition(n_tasks, "block"), own.repartition(n_tasks, "of_block")
    return mine.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(run, schema)


def _units(rows: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of units, the ids of their words, and their counts."""
    if "members" not in rows.column_names:
        return rows["unit"].to_numpy(), _keys(rows["key"], words), rows["f"].to_numpy()
    packed = [unpack(m) for m in rows["members"].to_pylist()]
    number, key, f = (np.concatenate([p[c] for p in packed]) for c in ("unit", "key", "f"))
    return number, key.reshape(-1, words), f


_MERGED = pa.schema(
    [("block", pa.int64()), ("members", pa.binary()), ("key", pa.binary()), ("f", pa.int64())]
)


def _merge(stripes: DataFrame, words: int, least: int, buckets: int) -> DataFrame:
    """Add stripes of equal prefix and shard, word by word.

    Gives ``key, f`` of every phrase of ``words + 1`` words that occurs at least
    ``least`` times, and ``block, members`` for the blocks that have them: the
    units of the block with their keys and counts, packed.
    """

    def added(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(packed) for _, _, packed in rows]
        whole = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        prefix, shard = whole["prefix"].reshape(-1, words), whole["shard"]
        by = np.lexsort((shard, *prefix.T))
        new = (prefix[by[1:]] != prefix[by[:-1]]).any(1) | (shard[by[1:]] != shard[by[:-1]])
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(np.append(0, new))
        stripe = np.repeat(np.arange(len(by)), whole["size"])
        sizes_ = [len(p["next"]) for p in parts]
        block = np.repeat([r[0] for r in rows], sizes_)
        unit = np.concatenate([r[1] + np.arange(k) for r, k in zip(rows, sizes_)])
        follows, n = whole["next"], whole["n"]
        order = np.lexsort((follows, group[stripe]))
        stripe, follows, n = stripe[order], follows[order], n[order]
        change = (group[stripe[1:]] != group[stripe[:-1]]) | (follows[1:] != follows[:-1])
        starts = np.flatnonzero(np.append(True, change))
        f = np.add.reduceat(n.astype(np.int64), starts)
        sizes = np.diff(np.append(starts, len(stripe)))
        frequent = f >= least
        kept = starts[frequent]
        if not len(kept):
            return
        key = np.column_stack([prefix[stripe[kept]], follows[kept]])
        for k in range(0, len(kept), 100_000):
            part = slice(k, k + 100_000)
            n_rows = len(kept[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n_rows, pa.int64()),
                    pa.nulls(n_rows, pa.binary()),
                    _key_column(key[part]),
                    pa.array(f[frequent][part]),
                ],
                schema=_MERGED,
            )
        if words + 1 < LONGEST:
            member = np.repeat(frequent, sizes)
            own = np.repeat(np.arange(len(kept)), sizes[frequent])
            block, unit = block[order][member], unit[order][member]
            yield from _packed(block, unit, key[own], f[frequent][own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != last and held:
                    yield from added(held)
                    held = []
                last = bucket
                held.append(row)
        if held:
            yield from added(held)

    met = stripes.select("bucket", "block", "first", "stripes")
    met = met.repartition(buckets // BUCKETS_EACH, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(run, "block long, members binary, key binary, f long")


def _packed(
    block: np.ndarray, unit: np.ndarray, key: np.ndarray, f: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """A row a block with what belongs to it."""
    order = np.lexsort((unit, block))
    block, unit, key, f = block[order], unit[order].astype(np.int32), key[order], f[order]
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    members = [
        pack({"unit": unit[a:b], "key": key[a:b].ravel(), "f": f[a:b]})
        for a, b in zip(starts, np.append(starts[1:], len(block)))
    ]
    n = len(starts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(block[starts]),
            pa.array(members, pa.binary()),
            pa.nulls(n, pa.binary()),
            pa.nulls(n, pa.int64()),
        ],
        schema=_MERGED,
    )


def _as_key(word_id: Column) -> Column:
    return F.unhex(F.lpad(F.hex(word_id), 16, "0"))


def _first_word(key: Column, k: int = 1) -> Column:
    return F.conv(F.hex(F.substring(key, 8 * k - 7, 8)), 16, 10).cast("long")


def collocations(
    docs: DataFrame,
    *,
    least: int = 30,
    subsumed_percent: int = 80,
    top: int = 2000,
    work: Stage | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each lang.

    A phrase of 2 to 4 words that occurs ``a >= least`` times is cut in two
    where ``2000000 * a / (l + r)``, rounded down, is lowest. It is left out if a
    phrase around it occurs at least ``subsumed_percent`` as often.
    """
    work = work or stage(docs.sparkSession, "collocations")
    folder = f"{work.root}/blocks"
    coded = work.cut(_coded(docs, folder), "coded")
    found = coded.filter("uri is null")
    # Every word is known by its first place, so one shuffle counts, numbers and finds it.
    every = Window.partitionBy("lang", "word")
    own = F.shiftleft("block", WORD_BITS).bitwiseOR(F.col("unit"))
    counted = found.select(
        "block",
        "unit",
        own.alias("own"),
        F.min(own).over(every).alias("id"),
        F.sum("n").over(every).alias("f"),
        "lang",
        "word",
    ).filter(F.col("f") >= least)
    first = F.col("own") == F.col("id")
    counted = work.cut(
        counted.select(
            "block", "unit", "id", "f", *[F.when(first, F.col(c)).alias(c) for c in ("lang", "word")]
        ),
        "words",
    )
    words = counted.filter("word is not null").select("lang", "word", "id", "f")
    sizes = found.groupBy("lang").agg(F.sum("n").alias("total"))

    blocks = coded.filter("uri is not null").select("block", "uri")
    units = counted.select("block", "unit", _as_key(F.col("id")).alias("key"), "f")
    levels = [words.select(_as_key(F.col("id")).alias("key"), "f")]
    buckets = BUCKETS_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for k in range(1, LONGEST):
        stripes = work.cut(_extend(blocks, units, k, folder, buckets), f"stripes-{k}")
        merged = _merge(stripes.filter("bucket is not null"), k, least, buckets)
        merged = work.cut(merged, f"merged-{k}")
        blocks = stripes.filter("bucket is null").select("block", "uri")
        units = merged.filter("block is not null").select("block", "members")
        levels.append(merged.filter("block is null").select("key", "f"))
    scored = work.cut(_scored(levels, subsumed_percent), "scored")
    return _ranked(scored, words, sizes, top)


def _scored(levels: list[DataFrame], percent: int) -> DataFrame:
    """``key, a, l, r, score`` of the candidates that no longer phrase covers."""
    phrases, candidates = levels[0], levels[1]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    for level in levels[2:]:
        candidates = candidates.unionByName(level)
    length = F.length("key")
    longer = candidates.filter(length > 16)
    around = F.explode(
        F.array(F.expr("substring(key, 1, length(key) - 8)"), F.expr("substring(key, 9)"))
    )
    # A phrase of two more words around it is no more frequent than the one between.
    largest = longer.select(around.alias("key"), "f").groupBy("key").agg(F.max("f").alias("most"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    free = (
        candidates.join(largest, "key", "left")
        .filter(F.col("most").isNull() | (exact("most") * 100 < exact("f") * percent))
        .select("key", F.col("f").alias("a"))
    )
    cuts = free.select("key", "a", F.explode(F.sequence(F.lit(1), F.expr("length(key) / 8 - 1").cast("int"))).alias("k"))
    cuts = cuts.select(
        "*",
        F.expr("substring(key, 1, 8 * k)").alias("head"),
        F.expr("substring(key, 8 * k + 1)").alias("tail"),
    )
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(phrases.select(F.col("key").alias(part), F.col("f").alias(name)), part)
    score = F.expr("(2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("key", "a").agg(lowest).select("key", "a", "cut.l", "cut.r", "cut.score")


def _ranked(scored: DataFrame, words: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    first = words.select(F.col("id").alias("first"), "lang")
    scored = scored.withColumn("first", _first_word(F.col("key"))).join(first, "first")
    rough = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    # Ties with the last place stay until their words are known.
    near = scored.withColumn("rank", F.rank().over(rough)).filter(F.col("rank") <= top)
    ids = F.array(*[_first_word(F.col("key"), k) for k in range(1, LONGEST + 1)])
    held = F.slice(ids, F.lit(1), (F.length("key") / 8).cast("int"))
    spelled = (
        near.select("lang", "key", "a", "l", "r", "score", F.posexplode(held).alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("lang", "key", "a", "l", "r", "score")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
    )
    spelled = spelled.withColumn("phrase", F.array_join(F.col("parts.word"), " "))
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    )
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("long"))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(sizes.withColumnRenamed("total", "n"), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
