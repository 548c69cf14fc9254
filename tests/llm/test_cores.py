"""The algorithms inside tasks, against plain brute force."""

import random

import numpy as np
from llm_data import hashed, near_sets

from lanewright.llm.decontaminate import tiles
from lanewright.llm.ngram_join import Forest, PrefixTree, _triangle


def plain_tiles(a, b, least):
    free_a, free_b, out = [True] * len(a), [True] * len(b), []

    def run(i, j):
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            if not (free_a[i + k] and free_b[j + k]):
                break
            k += 1
        return k

    while True:
        runs = [(-run(i, j), j, i) for j in range(len(b)) for i in range(len(a))]
        if not runs or -min(runs)[0] < least:
            return out
        best = -min(runs)[0]
        j, i = min((j, i) for k, j, i in runs if -k >= best)
        for x in range(best):
            free_a[i + x] = free_b[j + x] = False
        out.append((i, j, best))


def test_tiles():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(3) for _ in range(rng.randint(0, 30))]
        b = [rng.randrange(3) for _ in range(rng.randint(0, 20))]
        assert tiles(hashed(a), hashed(b), 3) == plain_tiles(a, b, 3)


def test_prefix_tree_finds_every_link():
    rng = random.Random(3)
    for _ in range(150):
        sets = near_sets(rng)
        forest, plain = Forest(len(sets)), Forest(len(sets))
        PrefixTree(sets).links(forest)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    plain.join(i, j)
        n = range(len(sets))
        assert [forest.find(i) for i in n] == [plain.find(i) for i in n]


def test_any_two_keys_meet_in_a_block_pair():
    keys = np.random.default_rng(0).integers(-(2**62), 2**62, 40)
    for blocks in (1, 2, 5):
        row, part = _triangle(keys, np.full(40, blocks))
        where = [set(part[row == k]) for k in range(40)]
        assert all(where[i] & where[j] for i in range(40) for j in range(40))
