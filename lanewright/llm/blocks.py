"""Documents in blocks, their words replaced by numbers of the block.

A block is a bounded stretch of documents of one task. Its words are numbered
as they appear and the numbers are written to a file of the shared folder; the
distinct words leave the task as rows. What is found out about a word by a join
comes back to its block as few rows, not once for every place in the corpus.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

from lanewright.llm.common import open_file, put_file

# Bits of the number of a block within its task, of a task, and of a word within its block.
BLOCK_BITS, TASK_BITS, WORD_BITS = 12, 20, 31

# A block is closed after the document that passes this many characters.
BLOCK_CHARS = 32_000_000


class Numbers(dict):
    """Word to its number, in order of first appearance."""

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        return number


def pack(arrays: dict[str, np.ndarray], level: int = 1) -> bytes:
    """Named arrays as compressed bytes, the bytes of equal weight side by side."""
    head = json.dumps([[k, a.dtype.str, len(a)] for k, a in arrays.items()]).encode()
    planes = [
        np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes()
        for a in arrays.values()
        if len(a)
    ]
    body = b"".join([struct.pack("<I", len(head)), head, *planes])
    return zstandard.ZstdCompressor(level=level).compress(body)


def unpack(data: bytes) -> dict[str, np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + struct.unpack_from("<I", body)[0]
    arrays = {}
    for name, kind, n in json.loads(body[4:at]):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
        arrays[name] = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * width
    return arrays


def save(folder: str, arrays: dict[str, np.ndarray]) -> str:
    return put_file(folder, "block", pack(arrays))


def load(uri: str) -> dict[str, np.ndarray]:
    with open_file(uri) as file:
        return unpack(file.read())


def in_blocks(
    batches: Iterator[pa.RecordBatch], add: Callable, close: Callable, size_of: Callable
) -> Iterator[pa.RecordBatch]:
    """Feed rows to ``add`` and call ``close(number of the block)`` when a block is full.

    A number takes 32 bits, so that it fits into 63 with the place of a word; a
    task of more blocks, or more tasks, end the job with an error.
    """
    task, k, size, open_ = TaskContext.get().partitionId(), 0, 0, False

    def number() -> int:
        if task >> TASK_BITS or k >> BLOCK_BITS:
            raise ValueError(f"block {k} of task {task}: too many to number, deal the input anew")
        return task << BLOCK_BITS | k

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            add(*row)
            size, open_ = size + size_of(*row), True
            if size >= BLOCK_CHARS:
                yield from close(number())
                k, size, open_ = k + 1, 0, False
    if open_:
        yield from close(number())


def binaries(data: bytes | np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie end to end in ``data``."""
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = ends
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary())
