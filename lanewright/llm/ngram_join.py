"""Join of documents whose word n-gram sets have a Jaccard similarity of 0.8 or more.

Sets are joined along prefix trees in a global order of their n-grams:

1. One pass gives every document its set size, a digest of its set, and a parity
   bitmap. Documents with equal sets form one class and go on as one.
2. N-grams that many documents share come last in the global order, the others
   first, by hash. Two sets that are similar enough share one of the first
   ``n - ceil(0.8 n) + 1`` n-grams of each. Only these prefixes move.
3. Classes that meet under a prefix n-gram must agree in length, position and
   bitmap (the parity bits that differ are a lower bound on the n-grams that
   differ). What agrees is joined into candidate groups by spanning edges, never
   by all pairs.
4. Each class sends its whole set to its candidate group once. There the sets
   form a trie in a global order with frequent n-grams first, so near copies
   share long paths. A probe keeps its partial overlap along a shared path, and
   leaves a subtree once the overlap and the n-grams that remain cannot reach
   the bound. Pairs already known to be connected are not compared.
5. Components of the verified links are labelled with the smallest doc_id.

Groups larger than a block are dealt out as pairs of blocks (triangle salting),
so no task holds a whole group however hot its n-gram is.

Defined cases: a null or blank text has an empty set, size 0, and is its own
component; a text with fewer words than an n-gram has one element, all its
words; rows that repeat a doc_id and its text each get a row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import (
    WordHashes,
    as_long,
    ascii_words,
    connected_components,
    ids_repeat,
    numbered_rows,
    shingle_hashes,
    stage,
    text_chunks,
    without_rows,
)
from lanewright.sources.staging import Stage

SHINGLE = 5
# N-grams that come last in the global order: at most this many, chosen by count.
# Their count is at least all n-grams / HOT_LIST, which bounds the list.
HOT_LIST = 1 << 22
HOT_LEAST = 16
_COUNT_AT = 4_000_000  # n-grams a task counts together
MEET_BLOCK = 1024  # classes of one prefix n-gram in a block
SET_BLOCK = 256  # sets of one candidate group in a block


def required_overlap(a, b):
    """Least intersection of sets of these sizes with 100 * inter >= 80 * union."""
    return (4 * (a + b) + 8) // 9


def prefix_length(n):
    return n - (4 * n + 4) // 5 + 1


def document_sets(pdf: pd.DataFrame, hashes: WordHashes) -> Iterator[tuple[int, np.ndarray]]:
    for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
        yield doc_id, np.unique(shingle_hashes(hashes.of(ascii_words(text)), SHINGLE))


def set_digest(grams: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64)))


def parity_bitmap(grams: np.ndarray) -> bytes:
    """Parity of the number of n-grams that fall on each of n to 2n bits, a power of
    two, so larger bitmaps fold onto smaller ones."""
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    places = (grams & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each document, and for each n-gram that this task sees twice."""
    hashes, seen, size = WordHashes(), [], 0

    def repeated() -> pd.DataFrame:
        grams, counts = np.unique(np.concatenate(seen), return_counts=True)
        twice = counts > 1
        return pd.DataFrame(
            {"kind": "gram", "a": as_long(grams[twice]), "n": counts[twice], "digest": 0, "bits": b""}
        )

    for batch in batches:
        for pdf in text_chunks(batch):
            rows = []
            for doc_id, grams in document_sets(pdf, hashes):
                rows.append(("doc", doc_id, len(grams), set_digest(grams), parity_bitmap(grams) if len(grams) else b""))
                seen.append(grams)
                size += len(grams)
            yield pd.DataFrame(rows, columns=["kind", "a", "n", "digest", "bits"])
            if size >= _COUNT_AT:
                yield repeated()
                seen, size = [], 0
    if size:
        yield repeated()


def _prefixes(hot_grams, hot_counts):
    """Rows of the prefix of every distinct set, with the block pairs of hot n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot, counts = hot_grams.value, hot_counts.value
        place = np.empty(len(hot), np.int64)
        place[np.lexsort((hot, counts))] = np.arange(1, len(hot) + 1)
        hashes, done = WordHashes(), set()
        for batch in batches:
            for pdf in text_chunks(batch):
                out = []
                for _, grams in document_sets(pdf, hashes):
                    n, digest = len(grams), set_digest(grams)
                    if not n or (digest, n) in done:
                        continue
                    done.add((digest, n))
                    late = np.zeros(n, np.int64)
                    blocks = np.ones(n, np.int64)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
                        is_hot = hot[at] == grams
                        late[is_hot] = place[at[is_hot]]
                        blocks[is_hot] = -(-counts[at[is_hot]] // MEET_BLOCK)
                    first = np.lexsort((grams, late))[: prefix_length(n)]
                    out.append((grams[first], np.arange(len(first)), n, digest, blocks[first]))
                if out:
                    yield _prefix_rows(out)

    return run


def _prefix_rows(out: list) -> pd.DataFrame:
    grams = np.concatenate([o[0] for o in out])
    pos = np.concatenate([o[1] for o in out])
    sizes = [len(o[0]) for o in out]
    n, digest = np.repeat([o[2] for o in out], sizes), np.repeat([o[3] for o in out], sizes)
    blocks = np.concatenate([o[4] for o in out])
    row, part = _triangle(digest, blocks)
    return pd.DataFrame(
        {"gram": as_long(grams)[row], "part": part, "n": n[row], "pos": pos[row], "digest": digest[row]}
    )


def _triangle(keys: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows repeated for each block pair they belong to, and the pair's number.

    A key has one of ``blocks`` salts; it goes to the pair of its salt with each
    salt, so any two keys meet in the pair of theirs.
    """
    row = np.repeat(np.arange(len(keys)), blocks)
    total = blocks[row]
    other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    salt = (keys.view(np.uint64)[row] >> np.uint64(20)).astype(np.int64) % total
    return row, np.minimum(salt, other) * total + np.maximum(salt, other)


def _meeting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by n-gram, part, size and class: those with a neighbour of
    another class and a fitting size."""
    carry: pd.DataFrame | None = None
    kept = False  # whether the row carried was already found to have a neighbour
    for batch in batches:
        pdf = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
        if not len(pdf):
            continue
        gram, part = pdf["gram"].to_numpy(), pdf["part"].to_numpy()
        n, digest = pdf["n"].to_numpy(), pdf["digest"].to_numpy()
        same = (gram[1:] == gram[:-1]) & (part[1:] == part[:-1])
        repeat = np.append(False, same & (digest[1:] == digest[:-1]) & (n[1:] == n[:-1]))
        if repeat.any():
            first_kept = kept
            pdf = pdf[~repeat].reset_index(drop=True)
            gram, part, n = (pdf[c].to_numpy() for c in ("gram", "part", "n"))
            same = (gram[1:] == gram[:-1]) & (part[1:] == part[:-1])
            kept = first_kept
        fits = same & (5 * n[:-1] >= 4 * n[1:])
        found = np.append(fits, False) | np.append(kept, fits)
        yield pdf[:-1][found[:-1]]
        carry, kept = pdf[-1:], bool(found[-1])
    if carry is not None and kept:
        yield carry


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows that are sorted by ``keys``, across batches."""
    waiting: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch) - 1, bool)
        for k in keys:
            v = batch[k].to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            piece = batch.iloc[a:b]
            if waiting and any(waiting[0][k].iloc[0] != piece[k].iloc[0] for k in keys):
                yield pd.concat(waiting) if len(waiting) > 1 else waiting[0]
                waiting = []
            waiting.append(piece)
    if waiting:
        yield pd.concat(waiting) if len(waiting) > 1 else waiting[0]


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def meeting_edges(n: np.ndarray, pos: np.ndarray, bitmaps: list[bytes], forest: Forest, node: list) -> list:
    """Spanning edges among classes that meet under one n-gram and pass the filters.

    Rows come in order of ``n``. ``node`` gives their places in ``forest``, which
    outlives the group: classes it already holds together need no edge.
    """
    edges = []
    widths = np.array([len(b) for b in bitmaps])
    by_width = {w: np.flatnonzero(widths == w) for w in np.unique(widths)}
    packed = {w: np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint8).reshape(len(at), w) for w, at in by_width.items()}
    left = n - pos - 1
    for i in range(1, len(n)):
        lo = int(np.searchsorted(n, -(-4 * n[i] // 5)))
        if lo >= i:
            continue
        own = np.frombuffer(bitmaps[i], np.uint8)
        for w, at in by_width.items():
            a, b = np.searchsorted(at, (lo, i))
            if a == b or w > len(own):
                continue
            js = at[a:b]
            need = required_overlap(n[js], n[i])
            fits = 1 + np.minimum(left[js], left[i]) >= need
            if not fits.any():
                continue
            apart = np.bitwise_count(packed[w][a:b] ^ _fold(own, w)).sum(1, dtype=np.int64)
            fits &= apart <= n[js] + n[i] - 2 * need
            for j in js[fits].tolist():
                if forest.join(node[i], node[j]):
                    edges.append((i, j))
    return edges


SMALL_GROUP = 24  # below it plain loops are faster than arrays


def _few_edges(n: list, pos: list, bitmaps: list, node: list, forest: Forest) -> list:
    """``meeting_edges`` of a few rows."""
    edges, numbers, widths = [], [int.from_bytes(b, "little") for b in bitmaps], [8 * len(b) for b in bitmaps]
    for i in range(1, len(n)):
        for j in range(i - 1, -1, -1):
            if 5 * n[j] < 4 * n[i]:
                break
            need = required_overlap(n[i], n[j])
            if n[i] - pos[i] < need or n[j] - pos[j] < need:
                continue
            if forest.find(node[i]) == forest.find(node[j]):
                continue
            own, width = numbers[i], widths[i]
            while width > widths[j]:
                width //= 2
                own = (own >> width) ^ (own & ((1 << width) - 1))
            if (own ^ numbers[j]).bit_count() <= n[i] + n[j] - 2 * need:
                forest.join(node[i], node[j])
                edges.append((i, j))
    return edges


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches that end where a group ends; rows are sorted by ``keys``."""
    carry: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = np.ones(len(batch), bool)
        for k in keys:
            v = batch[k].to_numpy()
            last &= v == v[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        same = carry and all(carry[0][k].iloc[0] == batch[k].iloc[0] for k in keys)
        if carry and (cut or not same):
            done = [*carry, batch[:cut]]
            yield pd.concat(done, ignore_index=True)
            carry = []
        elif cut:
            yield batch[:cut].reset_index(drop=True)
        carry.append(batch[cut:])
    if carry:
        yield pd.concat(carry, ignore_index=True)


def _candidate_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges that span what this task's n-grams connect."""
    number: dict[int, int] = {}
    forest = Forest(0)
    for block in _whole_groups(batches, ["gram", "part"]):
        rep = block["rep"].to_numpy()
        known, inverse = np.unique(rep, return_inverse=True)
        for r in known.tolist():
            if r not in number:
                number[r] = len(number)
                forest.parent.append(number[r])
        node = np.array([number[r] for r in known.tolist()])[inverse].tolist()
        gram, part = block["gram"].to_numpy(), block["part"].to_numpy()
        change = np.flatnonzero((gram[1:] != gram[:-1]) | (part[1:] != part[:-1])) + 1
        cuts = [0, *change.tolist(), len(block)]
        n, pos, bits = block["n"].tolist(), block["pos"].tolist(), block["bits"].tolist()
        found: list[tuple[int, int]] = []
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            root = forest.find(node[a])
            if all(forest.find(x) == root for x in node[a + 1 : b]):
                continue
            if b - a < SMALL_GROUP:
                edges = _few_edges(n[a:b], pos[a:b], bits[a:b], node[a:b], forest)
            else:
                edges = meeting_edges(np.array(n[a:b]), np.array(pos[a:b]), bits[a:b], forest, node[a:b])
            found.extend((a + i, a + j) for i, j in edges)
        if found:
            i, j = np.array(found).T
            yield pd.DataFrame({"a": rep[i], "b": rep[j]})


class PrefixTree:
    """Sets as paths of a trie, kept in preorder: paths sorted, with the depth that
    each shares with the path before it. A subtree is a stretch of paths whose
    shared depth stays above that of its root."""

    def __init__(self, sets: list[np.ndarray]):
        grams, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.empty(len(grams), np.int64)
        order[np.lexsort((grams, -counts))] = np.arange(len(grams))
        ranks = order[inverse]
        self.n_grams = len(grams)
        ends = np.cumsum([len(s) for s in sets])
        paths = [np.sort(ranks[e - len(s) : e]) for s, e in zip(sets, ends)]
        self.order = sorted(range(len(sets)), key=lambda k: paths[k].astype(">u4").tobytes())
        self.paths = [paths[k] for k in self.order]
        self.shared = [0] + [self._common(a, b) for a, b in zip(self.paths, self.paths[1:])]

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        return int(differ[0]) if len(differ) else m

    def links(self, forest: Forest) -> list[tuple[int, int]]:
        """Verified pairs (as given) that connect what ``forest`` does not yet."""
        found, member = [], np.zeros(self.n_grams, bool)
        below = np.zeros(self.n_grams + 1, np.int64)
        for i, x in enumerate(self.paths[:-1]):
            member[x] = True
            np.cumsum(member, out=below[1:])  # n-grams of the probe before a rank
            self._probe(i, x, member, below, forest, found)
            member[x] = False
        return found

    def _probe(self, i, x, member, below, forest, found) -> None:
        size, least = len(x), (4 * len(x) + 4) // 5
        overlap = np.zeros(1, np.int64)  # by depth, along the path visited last
        valid = 0  # depth to which ``overlap`` holds for the current path
        pruned = -1  # leave paths that share more than this depth, if not negative
        for j in range(i + 1, len(self.paths)):
            shared = self.shared[j]
            if pruned >= 0 and shared > pruned:
                continue
            pruned = -1
            valid = min(valid, shared)
            if forest.find(self.order[i]) == forest.find(self.order[j]):
                continue
            y = self.paths[j]
            tail = np.cumsum(member[y[valid:]]) + overlap[valid]
            overlap = np.concatenate([overlap[: valid + 1], tail])
            valid = len(y)
            # What the probe can still gain below each depth, whatever follows.
            reach = tail + size - below[y[len(y) - len(tail) :] + 1]
            short = np.flatnonzero(reach < least)
            if len(short):
                pruned = len(y) - len(tail) + int(short[0])
            elif overlap[-1] >= required_overlap(size, len(y)):
                forest.join(self.order[i], self.order[j])
                found.append((self.order[i], self.order[j]))


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for group in _groups(batches, ["component", "part"]):
        if len(group) < 2:
            continue
        rep = group["rep"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in group["grams"]]
        links = PrefixTree(sets).links(Forest(len(sets)))
        if links:
            i, j = np.array(links).T
            yield pd.DataFrame({"a": rep[i], "b": rep[j]})


def _set_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole sets, repeated for the block pairs of their candidate group."""
    hashes = WordHashes()
    for batch in batches:
        for pdf in text_chunks(batch):
            grams = [g.tobytes() for _, g in document_sets(pdf, hashes)]
            rep = pdf["doc_id"].to_numpy()
            row, part = _triangle(
                (rep * np.int64(0x5851F42D4C957F2D)).view(np.int64), pdf["blocks"].to_numpy(np.int64)
            )
            for a in range(0, len(row), 2000):
                own = row[a : a + 2000]
                yield pd.DataFrame(
                    {
                        "component": pdf["component"].to_numpy()[own],
                        "part": part[a : a + 2000],
                        "rep": rep[own],
                        "grams": [grams[k] for k in own],
                    }
                )


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Rows of one doc_id are linked by their own texts only. A row without doc_id
    is a row of its own; its component is named by the smallest doc_id in it, or
    null.
    """
    work: Stage = stage(docs.sparkSession, "ngram-join")
    texts = docs.select("doc_id", "text")
    if not ids_repeat(texts):
        return _components(texts, work)
    rows = numbered_rows(texts, work)
    found = _components(rows.select(F.col("__row").alias("doc_id"), "text"), work)
    found = found.withColumnRenamed("doc_id", "__row").join(rows.select("__row", "doc_id"), "__row")
    # Row numbers rise with doc_id, so the first row of a component has its smallest.
    named = rows.select(F.col("__row").alias("component_id"), F.col("doc_id").alias("smallest"))
    return found.join(named, "component_id").select(
        "doc_id", "n_shingles", F.col("smallest").alias("component_id")
    )


def _components(texts: DataFrame, work: Stage) -> DataFrame:
    """The same for rows whose doc_ids are unique."""
    spark = texts.sparkSession
    scan = work.cut(
        texts.mapInPandas(_scan, "kind string, a long, n long, digest long, bits binary"), "scan"
    )
    by_doc = scan.filter("kind = 'doc'").withColumnRenamed("a", "doc_id").drop("kind")
    total = by_doc.agg(F.sum("n")).first()[0] or 0
    bound = max(HOT_LEAST, -(-total // HOT_LIST))
    hot = (
        scan.filter("kind = 'gram'").groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= bound)
    ).toPandas()
    grams = hot["a"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    hot_grams = spark.sparkContext.broadcast(grams[order])
    hot_counts = spark.sparkContext.broadcast(hot["n"].to_numpy(np.int64)[order])

    classes = work.cut(
        by_doc.filter("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("rep")), "classes"
    )
    prefixes = texts.mapInPandas(
        _prefixes(hot_grams, hot_counts), "gram long, part long, n long, pos long, digest long"
    )
    meeting = (
        prefixes.repartition("gram", "part")
        .sortWithinPartitions("gram", "part", "n", "digest")
        .mapInPandas(_meeting, prefixes.schema)
    )
    bitmaps = (
        classes.join(by_doc, ["digest", "n"])
        .filter("doc_id = rep")
        .dropDuplicates(["rep"])
        .select("digest", "n", "rep", "bits")
    )
    edges = (
        meeting.join(bitmaps, ["digest", "n"])
        .select("gram", "part", "n", "pos", "rep", "bits")
        .repartition("gram", "part")
        .sortWithinPartitions("gram", "part", "n", "rep")
        .mapInPandas(_candidate_edges, "a long, b long")
    )
    groups = work.cut(connected_components(work, edges, "candidates"), "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / F.lit(float(SET_BLOCK))).alias("blocks")
    members = work.cut(
        groups.join(sizes, "component").select(F.col("node").alias("doc_id"), "component", blocks),
        "members",
    )
    links = (
        texts.join(members, "doc_id")
        .mapInPandas(_set_rows, "component long, part long, rep long, grams binary")
        .repartition("component", "part")
        .sortWithinPartitions("component", "part", "rep")
        .mapInPandas(_verified, "a long, b long")
    )
    found = connected_components(work, links, "links")
    labels = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", "n", F.coalesce("component", "rep").alias("component_id")
    )
    labels = work.cut(labels, "labels")
    return by_doc.join(labels, ["digest", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the row of the smallest doc_id of each component."""
    work = stage(docs.sparkSession, "ngram-keep")

    def others(rows: DataFrame) -> DataFrame:
        return similar_components(rows).filter("doc_id <> component_id").select("doc_id")

    return without_rows(docs, work, others)
