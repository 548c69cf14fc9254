"""Byte-level BPE over a table of distinct words, and its decoding.

Texts are split into words as the tokenizer file's splitter does. A block of
documents keeps the numbers of its words in a file and hands each distinct word
on once, packed with others of the same hash bucket; words meet by bucket, where
each distinct word of the corpus is encoded a single time. The ids go back to
the blocks. The distinct ids of a block are joined with the table of pieces on
the id, and the block lays ids and pieces out by position.

A bucket is one of as many as there are shuffle partitions. If its distinct
words pass MOST_WORDS, the table of words it has seen starts anew, and a word
that comes again is encoded again, to the same ids.

The table of pieces has one row an id of the tokenizer; that is its bound, and
it is checked before the table is broadcast.

Defined cases: null and empty texts give no ids and an empty text; a text of
any length is encoded whole; equal and null doc_ids are kept as rows of their
own; an empty table gives no rows; other columns are not read. The tokenizer's
special strings in a text give their special ids, as in the library. Decoded
bytes that are not UTF-8 become replacement characters.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.llm.blocks import Numbers, in_blocks, load, pack, save, unpack
from lanewright.llm.common import output_folder, stage
from lanewright.sources.staging import Stage

# Ids a tokenizer may have for its pieces to be broadcast.
MOST_PIECES = 1 << 20
# Symbols of a word up to which the best pair is looked for by going over all.
SHORT = 48
# Distinct words that one bucket keeps in memory.
MOST_WORDS = 1_000_000

# The printable stand-in of each byte, a fixed rule of the format: printable bytes stand
# for themselves, the others follow from code point 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in _PRINTABLE]
STAND_IN = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(_REST)}
BYTE_OF = {c: b for b, c in STAND_IN.items()}


def _ranges(wanted: Callable[[int], bool], end: int) -> str:
    """The code points under ``end`` as the inside of a character class."""
    parts, first = [], None
    for c in range(end + 1):
        inside = c < end and wanted(c)
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            parts.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(parts)


class Splitter:
    """The byte-level splitter: suffixes after an apostrophe, runs of letters, of numbers
    and of marks with the space before them, and white space.

    Characters that Python's tables do not know yet may be letters to the
    library; a text with one, or with any past the first 65,536, is split by the
    library.
    """

    def __init__(self, tokenizer):
        self.ascii_words = self._words(0x80)
        self.words = self._words(0x10000)
        kind = [unicodedata.category(chr(c)) for c in range(0x10000)]
        unassigned = _ranges(lambda c: kind[c] == "Cn", 0x10000)
        self.unusual = re.compile(f"[{unassigned}\\U00010000-\\U0010ffff]").search
        self.library = tokenizer.pre_tokenizer.pre_tokenize_str
        content = sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self.special = re.compile("|".join(map(re.escape, content))) if content else None
        self.marks = content

    @staticmethod
    def _words(end: int) -> Callable[[str], list[str]]:
        """The splitter for texts of code points under ``end``."""
        kind = [unicodedata.category(chr(c))[0] for c in range(end)]
        letters, numbers = (_ranges(lambda c, k=k: kind[c] == k, end) for k in "LN")
        # str.isspace also takes the four separators of ASCII, the splitter does not.
        spaces = _ranges(lambda c: chr(c).isspace() and not 0x1C <= c <= 0x1F, end)
        return re.compile(
            f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
            f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
        ).findall

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words(text)
        if self.unusual(text):
            return [text[a:b] for _, (a, b) in self.library(text)]
        return self.words(text)

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not any(mark in text for mark in self.marks):
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.plain(text[at:])


class Merges:
    """The merge rules of a tokenizer file, applied to one word at a time."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or described["normalizer"]:
            raise ValueError("not a plain byte-level BPE file")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.pieces = {i: bytes(map(BYTE_OF.__getitem__, p)) for p, i in ids.items()}
        self.pieces |= {i: p.encode() for p, i in self.special.items()}
        self.byte_id = [ids[STAND_IN[b]] for b in range(256)]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rules = {
            (ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)
        }

    def encode(self, word: str) -> list[int]:
        """Ids of a word: the pair of least rank is merged first, the leftmost of equals."""
        if word in self.special:
            return [self.special[word]]
        ids = [self.byte_id[b] for b in word.encode()]
        return self._few(ids) if len(ids) <= SHORT else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        rule = self.rules.get
        found = [rule(p) for p in zip(ids, ids[1:])]
        while True:
            best = min((r for r in found if r), default=None)
            if best is None:
                return ids
            k = found.index(best)
            ids[k : k + 2] = [best[1]]
            found[k : k + 1] = []
            if k:
                found[k - 1] = rule((ids[k - 1], best[1]))
            if k < len(found):
                found[k] = rule((best[1], ids[k + 1]))

    def _many(self, ids: list[int]) -> list[int]:
        """The same by a heap and links, for long words."""
        n, rule = len(ids), self.rules.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*r, k) for k, p in enumerate(zip(ids, ids[1:])) if (r := rule(p))]
        heap = [(rank, k, new) for rank, new, k in heap]
        heapq.heapify(heap)
        while heap:
            _, k, new = heapq.heappop(heap)
            other = right[k]
            # Gone, or merged since it was put here.
            if ids[k] < 0 or other < 0 or (found := rule((ids[k], ids[other]))) is None or found[1] != new:
                continue
            ids[k], ids[other], right[k] = new, -1, right[other]
            if right[k] >= 0:
                left[right[k]] = k
                if r := rule((new, ids[right[k]])):
                    heapq.heappush(heap, (r[0], k, r[1]))
            if left[k] >= 0 and (r := rule((ids[left[k]], new))):
                heapq.heappush(heap, (r[0], left[k], r[1]))
        return [i for i in ids if i >= 0]


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """``id, piece`` of a tokenizer file, one row an id."""
    pieces = Merges(path).pieces
    if len(pieces) > MOST_PIECES:
        raise ValueError(f"{len(pieces)} pieces are too many to broadcast")
    return spark.createDataFrame(list(pieces.items()), "id int, piece binary")


def _coded(docs: DataFrame, path: str, folder: str, buckets: int) -> DataFrame:
    """``block, uri`` once a block and, for each bucket of its distinct words, ``block,
    bucket, first, words``: the words packed, their numbers counting up from ``first``."""
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("uri", pa.string()),
            ("bucket", pa.int32()),
            ("first", pa.int32()),
            ("words", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        split, state = Splitter(Tokenizer.from_file(path)), {}

        def fresh() -> None:
            state.update(numbers=Numbers(), ids=[], codes=[])

        def add(doc_id, text) -> None:
            words = split(text)
            number = state["numbers"].__getitem__
            state["ids"].append(doc_id)
            state["codes"].append(np.fromiter(map(number, words), np.int32, len(words)))

        def close(block: int) -> Iterator[pa.RecordBatch]:
            ids, codes, numbers = state["ids"], state["codes"], state["numbers"]
            words = sorted(numbers)
            raw = [w.encode() for w in words]
            bucket = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in raw], np.int64)
            order = np.argsort(bucket, kind="stable")
            # Words are numbered anew by bucket, and by spelling inside it.
            new = np.empty(len(words), np.int32)
            new[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))[order]] = (
                np.arange(len(words))
            )
            arrays = {
                "has_id": np.array([i is not None for i in ids]),
                "doc_id": np.array([i or 0 for i in ids], np.int64),
                "length": np.array([len(c) for c in codes], np.int64),
                "code": new[np.concatenate(codes)] if words else np.zeros(0, np.int32),
            }
            fresh()
            rows = [(block, save(folder, arrays), None, None, None)]
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                part = [raw[k] for k in order[a:b]]
                packed = pack(
                    {
                        "length": np.array([len(w) for w in part], np.int32),
                        "bytes": np.frombuffer(b"".join(part), np.uint8),
                    },
                    level=3,
                )
                rows.append((block, None, int(bucket[order[a]]), a, packed))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

        fresh()
        yield from in_blocks(batches, add, close, lambda _, text: len(text or ""))

    return docs.select("doc_id", "text").mapInArrow(
        run, "block long, uri string, bucket int, first int, words binary"
    )


class _WordTable(dict):
    """Distinct words to their ids, little-endian."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
        ids = self[word] = np.array(self.merges.encode(word.decode()), "<u4").tobytes()
        return ids


def encode_words(coded: DataFrame, *, tokenizer_path: str, buckets: int) -> DataFrame:
    """``block, first, ids`` of ``block, bucket, first, words``; the words of a bucket meet
    and each distinct one is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, last, table = Merges(tokenizer_path), None, {}
        for batch in batches:
            ids = []
            for bucket, words in zip(batch["bucket"].to_pylist(), batch["words"].to_pylist()):
                if bucket != last:
                    last, table = bucket, _WordTable(merges)
                arrays = unpack(words)
                raw, ends = arrays["bytes"].tobytes(), np.cumsum(arrays["length"])
                starts = (ends - arrays["length"]).tolist()
                found = [table[raw[a:b]] for a, b in zip(starts, ends.tolist())]
                ids.append(
                    pack(
                        {
                            "length": np.array([len(f) // 4 for f in found], np.int32),
                            "id": np.frombuffer(b"".join(found), "<i4"),
                        }
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch["block"], batch["first"], pa.array(ids, pa.binary())],
                names=["block", "first", "ids"],
            )

    met = coded.select("block", "bucket", "first", "words")
    met = met.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(run, "block long, first int, ids binary")


def _dictionaries(ids: DataFrame, folder: str) -> DataFrame:
    """``block, dictionary`` once a block, a file of the ids of its words, and ``block, id``
    once a distinct id of it."""
    schema = pa.schema([("block", pa.int64()), ("dictionary", pa.string()), ("id", pa.int32())])

    def run(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("first")
        arrays = [unpack(p) for p in parts["ids"].to_pylist()]
        whole = {k: np.concatenate([a[k] for a in arrays]) for k in ("length", "id")}
        distinct = np.unique(whole["id"])
        n = len(distinct) + 1
        return pa.Table.from_arrays(
            [
                pa.array(np.full(n, parts["block"][0].as_py())),
                pa.array([save(folder, whole)] + [None] * (n - 1), pa.string()),
                pa.array([None, *distinct.tolist()], pa.int32()),
            ],
            schema=schema,
        )

    return ids.groupBy("block").applyInArrow(run, "block long, dictionary string, id int")


def _laid_out(
    docs: DataFrame, path: str, finish: Callable, schema: str, work: Stage | None
) -> DataFrame:
    """Ids and pieces of every document by position, through ``finish``."""
    spark = docs.sparkSession
    work = work or stage(spark, "byte-bpe")
    folder = f"{work.root}/blocks"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = work.cut(_coded(docs, path, folder, buckets), "coded")
    # The rows moved are few and small for the work they stand for, so the numbers of
    # tasks are said, not left to the sizes seen.
    ids = encode_words(coded.filter("uri is null"), tokenizer_path=path, buckets=buckets)
    ids = ids.repartition(buckets, "block")
    known = work.cut(_dictionaries(ids, folder), "dictionaries")
    files = known.filter("id is null").select("block", "dictionary")
    # Blocks of empty texts have no words, so no dictionary.
    blocks = coded.filter("uri is not null").select("block", "uri").join(files, "block", "left")
    pieces = known.filter("id is not null").join(F.broadcast(piece_table(spark, path)), "id")
    pieces = pieces.select(F.col("block").alias("of_block"), "id", "piece")

    def run(key, block: pa.Table, pieces_: pa.Table) -> pa.Table:
        if not block.num_rows:
            return wanted.empty_table()
        known, dictionary = load(block["uri"][0].as_py()), block["dictionary"][0].as_py()
        ids_of, text_of = _entries(load(dictionary), pieces_) if dictionary else ([], [])
        out, at = [], 0
        for has_id, doc_id, n in zip(
            known["has_id"].tolist(), known["doc_id"].tolist(), known["length"].tolist()
        ):
            codes = known["code"][at : at + n].tolist()
            at += n
            raw = b"".join(map(text_of.__getitem__, codes))
            packed = b"".join(map(ids_of.__getitem__, codes))
            out.append((doc_id if has_id else None, *finish(packed, raw)))
        columns = list(zip(*out)) if out else [[] for _ in wanted]
        return pa.Table.from_arrays(
            [pa.array(c, t.type) for c, t in zip(columns, wanted)], schema=wanted
        )

    wanted = _arrow(schema)
    blocks, pieces = blocks.repartition(buckets, "block"), pieces.repartition(buckets, "of_block")
    return blocks.groupBy("block").cogroup(pieces.groupBy("of_block")).applyInArrow(run, schema)


def _entries(ids: dict[str, np.ndarray], pieces: pa.Table) -> tuple[list[bytes], list[bytes]]:
    """Ids and decoded bytes of every word of a block."""
    piece_of = dict(zip(pieces["id"].to_pylist(), pieces["piece"].to_pylist()))
    parts = [piece_of[i] for i in ids["id"].tolist()]
    ends = np.cumsum(ids["length"])
    starts = ends - ids["length"]
    text, packed = b"".join(parts), ids["id"].astype("<u4").tobytes()
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return (
        [packed[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())],
        [text[a:b] for a, b in zip(at[starts].tolist(), at[ends].tolist())],
    )


_TYPES = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (f.split(" ") for f in schema.split(", "))])


def encode_documents(docs: DataFrame, *, tokenizer_path: str, work: Stage | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of every row of ``docs``, whole."""

    def finish(packed: bytes, raw: bytes):
        return np.frombuffer(packed, "<i4"), raw.decode("utf-8", "replace")

    schema = "doc_id long, ids array<int>, decoded string"
    return _laid_out(docs, tokenizer_path, finish, schema, work)


def encoding_digest(docs: DataFrame, *, tokenizer_path: str, work: Stage | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``."""

    def finish(packed: bytes, raw: bytes):
        text = raw.decode("utf-8", "replace").encode()
        return (
            len(packed) // 4,
            hashlib.sha256(packed).hexdigest(),
            hashlib.sha256(text).hexdigest(),
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _laid_out(docs, tokenizer_path, finish, schema, work)


def decode_documents(tokens: DataFrame, *, tokenizer_path: str) -> DataFrame:
    """``doc_id, decoded`` of ``doc_id, ids``: ids meet their pieces by a join and are put
    together by position. Null ids, and ids the tokenizer lacks, give nothing."""
    spark = tokens.sparkSession
    rows = tokens.select("doc_id", "ids").withColumn("row", F.monotonically_increasing_id())
    placed = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id"))
    table = F.broadcast(piece_table(spark, tokenizer_path))
    met = placed.join(table, "id", "left").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("parts"),
    )
    joined = F.array_join(F.transform("parts", lambda p: F.hex(p["piece"])), "")
    return met.select("doc_id", F.make_valid_utf8(F.unhex(joined).cast("string")).alias("decoded"))
