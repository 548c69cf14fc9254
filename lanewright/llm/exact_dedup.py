"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its bytes meets a pattern, so equal
stretches give equal chunks wherever they stand. Distinct chunk contents are
gathered once and every chunk identifier is verified against them: contents
that share a 128-bit hash get different variants. Two texts are equal exactly
when their ordered lists of verified identifiers are. Grouping moves these
lists (some ten bytes a kilobyte), never the texts.

Defined cases: a null text counts as empty; all empty texts are equal; a text
of any length is cut into chunks of at most MAX_CHUNK bytes; equal doc_ids are
kept as rows of their own; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import stage, text_chunks, without_rows

MIN_CHUNK, MAX_CHUNK = 512, 8192
# One position in 2**CUT_BITS is a cut, about 2 kB.
CUT_BITS = 11
WINDOW_STEPS = 5  # the rolling hash sees 2**5 bytes

_GEAR = np.frombuffer(
    b"".join(xxhash.xxh3_64_digest(bytes([b]), seed=11) for b in range(256)), np.uint64
)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks. A chunk's end depends on the 32 bytes before it and on
    the end of the chunk before; sizes lie between MIN_CHUNK and MAX_CHUNK, but
    for the last chunk."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for k in range(WINDOW_STEPS):
        step = 1 << k
        shifted = h[:-step] << np.uint64(step)
        h = h.copy()
        h[step:] += shifted
    marks = np.flatnonzero((h >> np.uint64(64 - CUT_BITS)) == 0) + 1
    ends, last = [], 0
    while n - last > MIN_CHUNK:
        k = int(np.searchsorted(marks, last + MIN_CHUNK))
        end = int(marks[k]) if k < len(marks) else n
        last = min(end, last + MAX_CHUNK, n)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunk(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _chunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for pdf in text_chunks(batch):
            parts = [p for t in pdf["text"] if t for p in chunk(t.encode())]
            yield pd.DataFrame({"id": [xxhash.xxh3_128_digest(p) for p in parts], "content": parts})


def _recipes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for pdf in text_chunks(batch):
            ids = [[xxhash.xxh3_128_digest(p) for p in chunk((t or "").encode())] for t in pdf["text"]]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "text_sha256": pdf["text_sha256"], "ids": ids}
            )


def _place_variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for pdf in text_chunks(batch):
            rows = [
                (d, k, xxhash.xxh3_128_digest(p), p)
                for d, t in zip(pdf["doc_id"], pdf["text"])
                for k, p in enumerate(chunk((t or "").encode()))
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "pos", "id", "content"])


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    work = stage(docs.sparkSession, "dedup")
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"))
    # Contents are grouped as they are, with map-side combine, so a chunk that
    # a third of all texts share leaves each task once.
    contents = (
        texts.select("text")
        .mapInPandas(_chunk_rows, "id binary, content binary")
        .groupBy("id", "content")
        .agg(F.count("*").alias("n"))
    )
    clashing = contents.groupBy("id").agg(F.count("*").alias("m")).filter("m > 1").select("id")
    clashing = work.cut(clashing, "clashing")
    recipes = work.cut(
        texts.withColumn("text_sha256", F.sha2("text", 256)).mapInPandas(
            _recipes, "doc_id long, text_sha256 string, ids array<binary>"
        ),
        "recipes",
    )
    if clashing.isEmpty():
        verified = recipes.withColumn("recipe", F.col("ids"))
    else:
        # Two contents under one identifier: the texts that hold such a chunk get
        # its SHA-512 appended, which tells the contents apart.
        held = recipes.select("doc_id", F.explode("ids").alias("id")).join(clashing, "id")
        held = held.select("doc_id").distinct()
        told_apart = (
            texts.join(held, "doc_id", "left_semi")
            .mapInPandas(_place_variants, "doc_id long, pos int, id binary, content binary")
            .withColumn("id", F.concat("id", F.unhex(F.sha2("content", 512))))
            .groupBy("doc_id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("r"))
            .select("doc_id", F.col("r.id").alias("longer"))
        )
        verified = recipes.join(told_apart, "doc_id", "left").withColumn(
            "recipe", F.coalesce("longer", "ids")
        )
    # Lists of identifiers group with map-side combine; the join back is split by
    # AQE where one recipe holds many rows, since both sides are exchanged for it.
    groups = work.cut(
        verified.groupBy("recipe").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    joined = verified.join(groups, "recipe")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text no row with a larger doc_id repeats.

    Of equal rows one stays; a row without doc_id gives way to any with one. Only
    repeated rows are looked up, so the texts that stay do not move when Spark
    finds that list small.
    """
    work = stage(docs.sparkSession, "dedup-drop")

    def repeated(rows: DataFrame) -> DataFrame:
        return duplicate_groups(rows).filter("NOT kept").select("doc_id")

    return without_rows(docs, work, repeated, nulls_last=False)
