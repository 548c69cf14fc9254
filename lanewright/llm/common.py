"""Helpers that several operators share."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.sources.staging import Stage, shared_folder

# Texts handed to numpy together; bounds the memory of one step in a task.
CHUNK_CHARS = 2_000_000
# Distinct words kept by a task's cache before it is emptied.
CACHE_WORDS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, name: str) -> Stage:
    """A new folder under the shared one, for this call of the operator."""
    return Stage(spark, f"{name}-{uuid.uuid4().hex}")


def output_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lanewright/{name}-{uuid.uuid4().hex}"


def put_file(folder: str, stem: str, data: bytes) -> str:
    """Write one file under a name no other attempt of the task uses.

    Only the name that the successful attempt returns is ever read, so a task
    that is run again after a lost executor leaves nothing wrong behind.
    """
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}"
    system, path = pafs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)
    return uri


def open_file(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def ids_repeat(docs: DataFrame) -> bool:
    """Whether a doc_id is null or stands for several rows."""
    counted = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    return not counted.filter("n > 1 OR doc_id IS NULL").isEmpty()


def numbered_rows(docs: DataFrame, work: Stage, nulls_last: bool = True) -> DataFrame:
    """``docs`` with ``__row``, unique and rising with doc_id, as a written table."""
    order = F.col("doc_id").asc_nulls_last() if nulls_last else F.col("doc_id").asc_nulls_first()
    rows = docs.orderBy(order).withColumn("__row", F.monotonically_increasing_id())
    return work.cut(rows, "numbered")


def without_rows(
    docs: DataFrame,
    work: Stage,
    dropped: Callable[[DataFrame], DataFrame],
    nulls_last: bool = True,
) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` the operator ``dropped`` returns.

    Where a doc_id is null or repeats, the operator is given row numbers that
    rise with it in its place, so each row is judged by its own text.
    """
    if not ids_repeat(docs):
        return docs.join(work.cut(dropped(docs), "dropped"), "doc_id", "left_anti").select(*docs.columns)
    rows = numbered_rows(docs, work, nulls_last)
    gone = dropped(rows.withColumn("doc_id", F.col("__row"))).withColumnRenamed("doc_id", "__row")
    return rows.join(work.cut(gone, "dropped"), "__row", "left_anti").select(*docs.columns)


def text_chunks(pdf: pd.DataFrame, column: str = "text") -> Iterator[pd.DataFrame]:
    """Slices of a batch with about CHUNK_CHARS characters, in row order."""
    if not len(pdf):
        return
    sizes = pdf[column].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
    part = np.cumsum(sizes) // CHUNK_CHARS
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(pdf)]):
        yield pdf.iloc[a:b]


def ascii_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of bytes outside ``[\\x20\\x09-\\x0D]``."""
    return text.encode("utf-8", "replace").lower().split() if text else []


class WordHashes(dict):
    """Word to 64-bit hash, with a bounded memory of words seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter text gives one for all of it."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    value = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        value = value * _ODD + hashes[k : n - width + 1 + k]
    return mix64(value)


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def as_unsigned(values: Iterable[int]) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def connected_components(stage_: Stage, edges: DataFrame, name: str) -> DataFrame:
    """``node, component`` for undirected ``a, b`` edges; component is the smallest node.

    Alternating large-star and small-star rounds. Each round is two groupings
    and two joins by equality on edges only, and is written to the shared
    folder, so plans stay short and a lost executor costs one round. Nothing
    is gathered on the driver. No edges give no rows.
    """
    spark = stage_.spark

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.filter("b < a")
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a")
        if large:
            moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            own = least.select("a", F.col("m").alias("b"))
            moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
        return moved.filter("a <> b").distinct()

    current = stage_.cut(edges.filter("a <> b").select("a", "b").distinct(), f"{name}-edges")
    seen = None
    for k in itertools.count():
        current = stage_.cut(star(star(current, True), False), f"{name}-{k}")
        mark = current.agg(
            F.count("*").alias("n"),
            F.expr("bit_xor(xxhash64(a, b))").alias("x"),
        ).first()
        if mark == seen:
            break
        seen = mark
    member = current.groupBy("a").agg(F.min("b").alias("component"))
    roots = member.select(F.col("component").alias("node")).distinct()
    return member.withColumnRenamed("a", "node").unionByName(
        roots.withColumn("component", F.col("node"))
    )
