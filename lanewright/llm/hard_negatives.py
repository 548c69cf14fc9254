"""Hard negatives of anchors, scored by tables of subset sums.

Vectors of whole numbers are cut into groups of eight dimensions. For an anchor
and a group, a table of 256 entries holds the sum of the anchor's components
over every subset of the group. A candidate is kept as bit planes: in a plane,
the byte of a group says which of its eight components have that bit. A score is
the sum, over planes and groups, of the table entry at the candidate's byte,
shifted by the plane; the top plane of the two's complement counts negative.
Every score is the full, exact inner product.

Anchors and candidates are packed in blocks of bounded size. Anchors are the
stated queries and meet every block of candidates, in a grid of cells: a row of
the shuffle is a whole block, and a cell holds one block of either kind at a
time. A cell keeps at most ``top`` rows a query, and those of all cells meet by
anchor. A first pass finds the positives, a second one the negatives between
the bounds that the positives set.

Defined cases: rows with a null id, label or vector, or with a null, NaN or
infinite component, take no part; vectors of fewer dimensions count as ended by
zeros, so an empty vector scores 0; rows of equal id are rows of their own,
never their own positive, and of equal score and id the one read first goes
first; scores that leave 62 bits are computed in exact Python integers by the
same tables, and one that a result must hold but leaves 64 bits ends the job
with an error; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.blocks import pack, unpack
from lanewright.llm.common import stage
from lanewright.sources.staging import Stage

# Rows packed together, and components a block may hold at most.
ANCHOR_ROWS, CANDIDATE_ROWS, BLOCK_VALUES = 128, 8192, 2_000_000
# Candidates scored against a block of anchors at a time.
STEP = 1024
# Blocks of either kind that a cell of the grid takes, on average.
CELL = 4


def whole_numbers(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, or as Python integers if one is too large."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        return np.array([int(x) for x in scaled], object)
    return scaled.astype(np.int64)


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes ``[plane, group, row]`` of two's complement numbers, lowest plane first."""
    rows, dims = vectors.shape
    if vectors.size:
        widest = max(int(vectors.max()).bit_length(), (-int(vectors.min()) - 1).bit_length())
    else:
        widest = 0
    padded = np.zeros((rows, -(-dims // 8) * 8), vectors.dtype)
    padded[:, :dims] = vectors
    planes = np.empty((widest + 1, padded.shape[1] // 8, rows), np.uint8)
    for j in range(widest + 1):
        bits = ((padded >> j) & 1).astype(np.uint8)
        planes[j] = np.packbits(bits, axis=1, bitorder="little").T
    return planes


def subset_sums(vectors: np.ndarray) -> np.ndarray:
    """Tables ``[group, subset, anchor]``: each entry adds one component to a smaller subset."""
    rows, dims = vectors.shape
    padded = np.zeros((rows, -(-dims // 8) * 8), vectors.dtype)
    padded[:, :dims] = vectors
    groups = padded.T.reshape(-1, 8, rows)
    sums = np.zeros((len(groups), 256, rows), vectors.dtype)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + groups[:, k : k + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products ``[candidate, anchor]`` by looking up and adding, shifted by plane."""
    total = np.zeros((planes.shape[2], sums.shape[2]), sums.dtype)
    for j, plane in enumerate(planes):
        part = np.zeros_like(total)
        for table, subset in zip(sums, plane):
            part += table[subset]
        if j == len(planes) - 1:
            total -= part << j
        else:
            total += part << j
    return total


def _dense(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Vectors of one block as a matrix, short ones ended by zeros."""
    dims = int(lengths.max(initial=0))
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), flat.dtype)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _packed_vectors(vectors: np.ndarray) -> dict[str, np.ndarray]:
    if vectors.dtype != object:
        return {"vectors": vectors.ravel()}
    digits = ["%d" % v for v in vectors.ravel()]
    return {"digits": np.frombuffer(" ".join(digits).encode(), np.uint8)}


def _unpacked_vectors(block: dict[str, np.ndarray]) -> np.ndarray:
    rows = len(block["vec_id"])
    if "vectors" in block:
        return block["vectors"].reshape(rows, -1) if rows else np.zeros((0, 0), np.int64)
    digits = block["digits"].tobytes().decode().split(" ")
    return np.array([int(d) for d in digits], object).reshape(rows, -1)


def _pack_blocks(rows: DataFrame, n_rows: int, scale: float) -> DataFrame:
    """``block, data``: rows of a task in blocks of bounded size, sorted by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Up to the row that fills the block.
                lengths = batch["embedding"].value_lengths().to_numpy()[at:]
                rest = n_rows - sum(len(b) for b in held)
                fits = np.searchsorted(np.cumsum(lengths), BLOCK_VALUES - size) + 1
                part = batch.slice(at, int(min(rest, fits)))
                held.append(part)
                at += len(part)
                size += int(lengths[: len(part)].sum())
                if size >= BLOCK_VALUES or sum(len(b) for b in held) >= n_rows:
                    yield closed(base | k, held)
                    k, held, size = k + 1, [], 0
        if held:
            yield closed(base | k, held)

    def closed(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        vectors = table["embedding"].chunk(0)
        ids, row = table["vec_id"].to_numpy(), table["row"].to_numpy()
        flat = whole_numbers(vectors.flatten().to_numpy(zero_copy_only=False), scale)
        matrix = _dense(flat, vectors.value_lengths().to_numpy())
        order = np.lexsort((row, ids))
        data = {"vec_id": ids[order], "row": row[order], "label": table["label"].to_numpy()[order]}
        data |= _packed_vectors(matrix[order])
        return pa.RecordBatch.from_pydict({"block": [block], "data": [pack(data)]})

    return rows.select("vec_id", "row", "label", "embedding").mapInArrow(
        run, "block long, data binary"
    )


def _cells(anchors: DataFrame, candidates: DataFrame, score, schema: str) -> DataFrame:
    """``score(anchor block, candidate block)`` of every pair of blocks.

    The grid has as many lanes of candidate blocks and bands of anchor blocks as
    their counts ask for, so the work of a cell does not grow with the input.
    """
    lanes, bands = (max(1, -(-side.count() // CELL)) for side in (candidates, anchors))

    def own(n: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = candidates.select(
        own(lanes).alias("lane"), every(bands).alias("band"), F.col("data").alias("candidate_data")
    )
    copied = anchors.select(
        every(lanes).alias("lane"),
        own(bands).alias("band"),
        F.col("block").alias("anchor_block"),
        F.col("data").alias("anchor_data"),
    )
    met = copied.join(dealt, ["lane", "band"]).select("anchor_block", "anchor_data", "candidate_data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            for block, mine, theirs in zip(*[c.to_pylist() for c in batch.columns]):
                if block != last:
                    last, known = block, _Anchors(unpack(mine))
                yield from score(known, unpack(theirs))

    return met.mapInArrow(run, schema)


class _Anchors:
    """A block of anchors with its tables, made once for all the candidates that meet it."""

    def __init__(self, block: dict[str, np.ndarray]):
        self.block, self.vectors = block, _unpacked_vectors(block)
        self.sums = subset_sums(self.vectors)
        self.largest = max(map(abs, _ends(self.vectors)))
        self.wide: np.ndarray | None = None

    def steps(self, theirs: dict[str, np.ndarray]) -> Iterator[tuple[slice, np.ndarray]]:
        """Slices of the candidates with their scores."""
        vectors = _unpacked_vectors(theirs)
        dims = min(vectors.shape[1], self.vectors.shape[1])
        vectors = vectors[:, :dims]
        lowest, highest = _ends(vectors)
        bits = max(highest.bit_length(), (-lowest - 1).bit_length()) + 1
        sums = self.sums
        # Partial sums reach the number of dimensions times the largest entry, shifted by a plane.
        if dims * self.largest << bits >= 1 << 62 and sums.dtype != object:
            if self.wide is None:
                self.wide = self.sums.astype(object)
            sums = self.wide
        sums = sums[: -(-dims // 8)]
        planes = bit_planes(vectors)
        for a in range(0, len(vectors), STEP):
            yield slice(a, a + STEP), scores(sums, planes[:, :, a : a + STEP])


def _ends(vectors: np.ndarray) -> tuple[int, int]:
    return (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)


def _best(value: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest values, ties by smaller id and row."""
    if len(value) > 4 * n and value.dtype != object:
        least = np.partition(value, len(value) - n)[len(value) - n]
        places = np.flatnonzero(value >= least)
    else:
        places = np.arange(len(value))
    if value.dtype == object:
        order = sorted(places, key=lambda k: (-value[k], ids[k], rows[k]))
        return np.array(order[:n], np.int64)
    return places[np.lexsort((rows[places], ids[places], -value[places]))][:n]


def _batch(schema: pa.Schema, found: list[tuple]) -> Iterator[pa.RecordBatch]:
    if found:
        columns = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


_POSITIVES = pa.schema(
    [("anchor_row", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.string())]
)
_NEGATIVES = pa.schema(
    [("anchor_row", pa.int64()), ("positive", pa.int32()), ("vec_id", pa.int64()),
     ("row", pa.int64()), ("score", pa.string())]
)


def _find_positives(top: int):
    def score(anchors: _Anchors, theirs: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, found = anchors.block, []
        for part, values in anchors.steps(theirs):
            ids, rows, labels = theirs["vec_id"][part], theirs["row"][part], theirs["label"][part]
            for k in range(len(own["row"])):
                places = np.flatnonzero((labels == own["label"][k]) & (rows != own["row"][k]))
                for i in places[_best(values[places, k], ids[places], rows[places], top)]:
                    found.append((own["row"][k], ids[i], rows[i], str(values[i, k])))
        yield from _batch(_POSITIVES, found)

    return score


def _find_negatives(top: int, least_percent: int):
    def score(anchors: _Anchors, theirs: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, found = anchors.block, []
        limits = [int(s) for s in own["limits"].tobytes().decode().split(" ")]
        for part, values in anchors.steps(theirs):
            ids, rows, labels = theirs["vec_id"][part], theirs["row"][part], theirs["label"][part]
            at = 0
            for k, n in enumerate(own["n_limits"].tolist()):
                highest, at = limits[at : at + n], at + n
                # Lowest whole score with 100 * score >= least_percent * positive.
                lowest = [-(-least_percent * s // 100) for s in highest]
                column = values[:, k]
                near = (labels != own["label"][k]) & (column >= min(lowest)) & (column <= max(highest))
                places = np.flatnonzero(near)
                for p, (low, high) in enumerate(zip(lowest, highest)):
                    inside = places[(column[places] >= low) & (column[places] <= high)]
                    for i in inside[_best(column[inside], ids[inside], rows[inside], top)]:
                        found.append((own["row"][k], p, ids[i], rows[i], str(column[i])))
        yield from _batch(_NEGATIVES, found)

    return score


def _first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The first ``top`` rows of each key, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row")
    exact = rows.withColumn("score", F.col("score").cast("long"))
    return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def hard_negatives(
    vectors: DataFrame,
    *,
    is_anchor: Column,
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 5,
    least_percent: int = 80,
    work: Stage | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, embedding, label``; ``is_anchor`` is an expression
    over them. A positive is one of the first ``n_positives`` other rows of the
    anchor's label; its negatives are the first ``n_negatives`` rows of other
    labels that score between ``least_percent`` of its score and its score.
    """
    work = work or stage(vectors.sparkSession, "hard-negatives")
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = vectors.filter("vec_id is not null and label is not null and embedding is not null")
    rows = whole.filter(finite).select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.col("embedding").cast("array<double>"),
        is_anchor.alias("is_anchor"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = work.cut(rows, "rows")
    anchors = rows.filter("is_anchor")
    anchors = anchors.repartition(max(1, -(-anchors.count() // ANCHOR_ROWS)))
    blocks = work.cut_all(
        {
            "candidates": _pack_blocks(rows, CANDIDATE_ROWS, scale),
            "anchors": _pack_blocks(anchors, ANCHOR_ROWS, scale),
        }
    )
    candidates, anchors = blocks["candidates"], blocks["anchors"]
    found = _cells(
        anchors, candidates, _find_positives(n_positives),
        "anchor_row long, vec_id long, row long, score string",
    )
    positives = work.cut(_first(found, ["anchor_row"], n_positives), "positives")
    limited = work.cut(_with_limits(anchors, positives), "limited")
    found = _cells(
        limited, candidates, _find_negatives(n_negatives, least_percent),
        "anchor_row long, positive int, vec_id long, row long, score string",
    )
    negatives = _first(found, ["anchor_row", "positive"], n_negatives)
    ids = rows.filter("is_anchor").select(
        F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")
    )
    chosen = positives.select(
        "anchor_row",
        (F.col("rank") - 1).alias("positive"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        negatives.join(chosen, ["anchor_row", "positive"])
        .join(ids, "anchor_row")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _with_limits(anchors: DataFrame, positives: DataFrame) -> DataFrame:
    """Blocks of anchors with the scores of their positives; anchors without one go."""
    members = anchors.mapInArrow(_members, "anchor_row long, block long")
    limits = (
        members.join(positives.select("anchor_row", "rank", "score"), "anchor_row")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("anchor_row", "rank", "score"))).alias("limits"))
    )
    joined = anchors.join(limits, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, listed in zip(*[c.to_pylist() for c in batch.columns]):
                arrays, of = unpack(data), {}
                for limit in listed:
                    of.setdefault(limit["anchor_row"], []).append(limit["score"])
                kept = np.array([r in of for r in arrays["row"].tolist()])
                lists = [of[r] for r in arrays["row"][kept].tolist()]
                text = " ".join(str(s) for scores_ in lists for s in scores_)
                matrix = _unpacked_vectors(arrays)[kept]
                new = {k: arrays[k][kept] for k in ("vec_id", "row", "label")}
                new["n_limits"] = np.array([len(s) for s in lists], np.int64)
                new["limits"] = np.frombuffer(text.encode(), np.uint8)
                new |= _packed_vectors(matrix)
                yield pa.RecordBatch.from_pydict({"block": [block], "data": [pack(new)]})

    return joined.select("block", "data", "limits").mapInArrow(run, "block long, data binary")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data in zip(*[c.to_pylist() for c in batch.columns]):
            rows = unpack(data)["row"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.full(len(rows), block))], names=["anchor_row", "block"]
            )
