"""Both forms of the meeting filter keep every pair that is similar enough."""

import random

import numpy as np
import pandas as pd
from llm_data import near_sets

from lanewright.llm.ngram_join import (
    Forest,
    _few_edges,
    _meeting,
    _whole_groups,
    meeting_edges,
    parity_bitmap,
    prefix_length,
    required_overlap,
)


def meeting_group(rng):
    sets = near_sets(rng)
    common = next((g for g in sets[0][: prefix_length(len(sets[0]))]), None)
    rows = []
    for s in sets:
        at = np.flatnonzero(s == common)
        if len(at) and at[0] < prefix_length(len(s)):
            rows.append((len(s), int(at[0]), s))
    return sorted(rows, key=lambda r: (r[0], r[1]))


def test_no_similar_pair_is_lost():
    rng = random.Random(5)
    for _ in range(300):
        rows = meeting_group(rng)
        if len(rows) < 2:
            continue
        n, pos = [r[0] for r in rows], [r[1] for r in rows]
        bits = [parity_bitmap(r[2]) for r in rows]
        node = list(range(len(rows)))
        one, two = Forest(len(rows)), Forest(len(rows))
        meeting_edges(np.array(n), np.array(pos), bits, one, node)
        _few_edges(n, pos, bits, node, two)
        for i in node:
            assert one.find(i) == two.find(i)
            for j in range(i):
                both = np.intersect1d(rows[i][2], rows[j][2])
                # The filters hold at the first n-gram that two sets share.
                first = both[0] == rows[i][2][pos[i]] if len(both) else False
                if first and len(both) >= required_overlap(n[i], n[j]):
                    assert one.find(i) == one.find(j)


def test_groups_are_whole_across_batches():
    keys = np.sort(np.random.default_rng(1).integers(0, 9, 60))
    table = pd.DataFrame({"k": keys, "v": range(60)})
    for size in (1, 2, 7, 60):
        parts = [table[i : i + size] for i in range(0, 60, size)]
        out = list(_whole_groups(iter(parts), ["k"]))
        assert pd.concat(out)["v"].tolist() == list(range(60))
        seen = [set(o["k"]) for o in out]
        assert all(a.isdisjoint(b) for i, a in enumerate(seen) for b in seen[:i])


def test_meeting_keeps_neighbours_across_batches():
    rows = [(g, 0, n, p, d) for g in range(4) for n, p, d in [(10, 0, 1), (10, 0, 1), (11, 1, 2), (30, 2, 3)]]
    table = pd.DataFrame(rows, columns=["gram", "part", "n", "pos", "digest"])
    for size in (1, 3, 16):
        parts = [table[i : i + size] for i in range(0, len(table), size)]
        out = pd.concat(list(_meeting(iter(parts))))
        assert sorted(zip(out["gram"], out["digest"])) == [(g, d) for g in range(4) for d in (1, 2)]
