"""Data that several tests use."""

import numpy as np

from lanewright.llm.common import mix64


def hashed(values):
    return mix64(np.array(list(values), np.uint64) + np.uint64(5))


def near_sets(rng):
    sets = []
    for _ in range(4):
        base = rng.sample(range(10000), rng.randint(3, 60))
        for _ in range(rng.randint(1, 6)):
            own = set(base)
            for _ in range(rng.randint(0, max(1, len(base) // 7))):
                if own:
                    own.discard(rng.choice(sorted(own)))
                own.add(rng.randrange(10000))
            sets.append(np.unique(hashed(sorted(own))))
    rng.shuffle(sets)
    return sets
