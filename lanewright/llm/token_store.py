"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every
id; a bitmap says which ids go on, and level 1 holds the next chunk of only
those, and so on. A rank directory gives the number of set bits before any
place, so id number i is found with one step a level and no block decoding.

Files hold documents in ascending doc_id order, with their ids and lengths.

Defined cases: a null text is empty and gives the end id only; a text may be of
any length (its ids are held by one task, about two bytes each, and a file is
closed after the document that passes ROLL_IDS); equal doc_ids are kept as rows
of their own; an empty table gives no files and no rows; other columns are not
read.
"""

from __future__ import annotations

import json
import re
import string
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.common import (
    CACHE_WORDS,
    open_file,
    output_folder,
    put_file,
    stage,
    text_chunks,
)

_MAGIC = b"DACTOK1\n"
RANK_BLOCK = 512  # bits between two entries of the rank directory
ROLL_IDS = 8_000_000


class Codes:
    """Directly addressable codes over an array of non-negative ids."""

    def __init__(self, levels: list[np.ndarray], bitmaps: list[np.ndarray], ranks: list[np.ndarray]):
        self.levels, self.bitmaps, self.ranks = levels, bitmaps, ranks

    @classmethod
    def encode(cls, ids: np.ndarray) -> Codes:
        rest, levels, bitmaps, ranks = ids.astype(np.uint32), [], [], []
        while True:
            levels.append((rest & 0xFF).astype(np.uint8))
            goes_on = rest > 0xFF
            if not goes_on.any():
                return cls(levels, bitmaps, ranks)
            bits = np.packbits(goes_on, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BLOCK // 8), np.uint8)])
            counts = np.bitwise_count(bits).reshape(-1, RANK_BLOCK // 8).sum(1, dtype=np.uint64)
            bitmaps.append(bits)
            ranks.append(np.concatenate([[np.uint64(0)], np.cumsum(counts)]).astype(np.uint64))
            rest = rest[goes_on] >> 8

    def __len__(self) -> int:
        return len(self.levels[0])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        block, bits = i // RANK_BLOCK, self.bitmaps[level]
        first = block * RANK_BLOCK // 8
        whole = int(np.bitwise_count(bits[first : i // 8]).sum())
        part = int(bits[i // 8]) & ((1 << (i % 8)) - 1) if i % 8 else 0
        return int(self.ranks[level][block]) + whole + part.bit_count()

    def __getitem__(self, i: int) -> int:
        value = 0
        for level in range(len(self.levels)):
            value |= int(self.levels[level][i]) << (8 * level)
            if level >= len(self.bitmaps) or not self.bitmaps[level][i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b``: one rank a level, then runs of bytes."""
        out = self.levels[0][a:b].astype(np.uint32)
        places = np.arange(b - a)
        for level, bits in enumerate(self.bitmaps):
            window = np.unpackbits(bits[a // 8 : (b + 7) // 8], bitorder="little")
            goes_on = window[a % 8 : a % 8 + b - a].astype(bool)
            places = places[goes_on]
            a, b = self._rank(level, a), self._rank(level, a) + len(places)
            if not len(places):
                break
            out[places] |= self.levels[level + 1][a:b].astype(np.uint32) << (8 * (level + 1))
        return out


def pack_file(doc_ids: np.ndarray, lengths: np.ndarray, codes: Codes) -> bytes:
    arrays = [doc_ids.astype("<i8"), lengths.astype("<i8"), *codes.levels, *codes.bitmaps]
    arrays += [r.astype("<u8") for r in codes.ranks]
    head = json.dumps(
        {"levels": len(codes.levels), "arrays": [[a.dtype.str, len(a)] for a in arrays]}
    ).encode()
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, *[a.tobytes() for a in arrays]])


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray, Codes]:
    if data[: len(_MAGIC)] != _MAGIC:
        raise ValueError("not a token file")
    at = len(_MAGIC) + 4
    size = struct.unpack("<I", data[at - 4 : at])[0]
    head = json.loads(data[at : at + size])
    at, arrays = at + size, []
    for kind, n in head["arrays"]:
        arrays.append(np.frombuffer(data, kind, n, at))
        at += arrays[-1].nbytes
    n = head["levels"]
    return arrays[0], arrays[1], Codes(arrays[2 : 2 + n], arrays[2 + n : 1 + 2 * n], arrays[1 + 2 * n :])


# The printable stand-in of each byte under byte-level coding, a fixed rule of the format:
# printable bytes stand for themselves, the others follow from code point 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in _PRINTABLE]
_STAND_IN = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(_REST)}
# Letters that are in composed form and have one lower-case letter each.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿœŒ]+")

# Marks the splitter keeps together in one piece; an apostrophe may start a suffix instead.
_MARKS = string.punctuation.replace("'", "").encode()


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _ChunkIds(dict):
    """Chunk to packed ids, filled on first use, with a bounded memory.

    A full memory becomes the older half; what is asked for again moves back
    to the younger one, so common chunks outlive the rare ones around them.
    """

    def __init__(self, ids_of):
        super().__init__()
        self.ids_of, self.older = ids_of, {}

    def __missing__(self, chunk):
        if len(self) >= CACHE_WORDS // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.ids_of(chunk)
        self[chunk] = ids
        return ids


class WordEncoder:
    """A tokenizers file, applied chunk by chunk between ASCII white space.

    The tokenizer drops white space and never looks across it, so the ids of a
    text are those of its chunks, and a chunk is encoded once while it stays in
    the bounded cache. A chunk of plain letters, with marks or none, has its
    letters sent straight to the library's BPE model, as the normaliser and the
    splitter would hand them over; every other chunk goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.letters = _ChunkIds(self._ids), _ChunkIds(self._letter_ids)
        self.tokenize = self.tokenizer.model.tokenize
        self.marks = _ChunkIds(lambda mark: self._whole(mark.decode()))

    def _whole(self, chunk: str) -> bytes:
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _letter_ids(self, letters: str) -> bytes:
        return _packed([t.id for t in self.tokenize(letters)])

    def _ids(self, chunk: bytes) -> bytes:
        word = chunk.rstrip(_MARKS)
        if word.isalpha():  # of bytes: ASCII letters only
            letters = word.lower().decode()
        else:
            text = word.decode()
            if not _PLAIN.fullmatch(text):
                return self._whole(chunk.decode())
            letters = text.lower().encode().decode("latin-1").translate(_STAND_IN)
        ids = self.letters[letters]
        return ids + self.marks[chunk[len(word) :]] if len(word) < len(chunk) else ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        get = self.known.__getitem__
        return [
            np.frombuffer(b"".join(map(get, (t or "").encode().split())), np.uint32) for t in texts
        ]


def write_tokens(docs: DataFrame, *, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode ``doc_id, text`` into files; return their manifest.

    Texts are dealt by ranges of doc_id before they are encoded, once. A file
    holds one stretch of documents; the manifest row tells where it starts.
    """
    spark = docs.sparkSession
    folder, work = output_folder(spark, "tokens"), stage(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, docs_, ids, size = WordEncoder(tokenizer_path), [], [], 0
        for batch in batches:
            for pdf in text_chunks(batch):
                docs_.extend(pdf["doc_id"])
                for one in encoder.encode(list(pdf["text"])):
                    ids.append(np.append(one, np.uint32(end_id)).astype(np.uint32))
                    size += len(ids[-1])
                if size >= ROLL_IDS:
                    yield saved(docs_, ids)
                    docs_, ids, size = [], [], 0
        if docs_:
            yield saved(docs_, ids)

    def saved(doc_ids: list, ids: list) -> pd.DataFrame:
        lengths = np.array([len(x) for x in ids])
        codes = Codes.encode(np.concatenate(ids))
        path = put_file(folder, "tokens.dac", pack_file(np.array(doc_ids), lengths, codes))
        return pd.DataFrame(
            {"path": [path], "first_doc": [doc_ids[0]], "last_doc": [doc_ids[-1]], "n_ids": [len(codes)]}
        )

    schema = "path string, first_doc long, last_doc long, n_ids long"
    files = work.cut(ordered.mapInPandas(write, schema), "files")
    # One row a file of millions of ids, so this one ordering stays small.
    before = Window.orderBy("first_doc", "last_doc", "path").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` for every document in the files, ids as
    little-endian unsigned 32-bit integers. ``start`` counts all ids before."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                with open_file(path) as file:
                    doc_ids, lengths, codes = unpack_file(file.read())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                for k in range(0, len(doc_ids), 500):
                    part = slice(k, min(k + 500, len(doc_ids)))
                    yield pd.DataFrame(
                        {
                            "doc_id": doc_ids[part],
                            "start": start + starts[part],
                            "n_tokens": lengths[part],
                            "ids": [
                                codes.slice(a, b).astype("<u4").tobytes()
                                for a, b in zip(starts[part], ends[part])
                            ],
                        }
                    )

    schema = "doc_id long, start long, n_tokens long, ids binary"
    return manifest.select("path", "start").repartition(n).mapInPandas(read, schema)


def token_digest(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

