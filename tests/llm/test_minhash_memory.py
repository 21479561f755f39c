"""What a worker of the MinHash operator holds."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tarnweave.llm import minhash
from tarnweave.llm.text import WordHashes


def test_a_full_bucket_of_near_copies_is_compared_in_little_memory():
    p = minhash.MinHashParams(width=3, percent=85, bands=24, rows=5)
    rng = np.random.default_rng(0)
    base, made = rng.integers(0, 2**63, 400).astype(np.uint64), []
    for _ in range(p.block):
        s = base.copy()
        s[rng.choice(len(s), 4, replace=False)] = rng.integers(0, 2**63, 4)
        least = minhash.minima(np.unique(s), p)
        made.append((minhash.signature(least), [7, *minhash.band_keys(least, p).tolist()[1:]]))
    zeros = np.zeros(p.block, np.int32)
    table = pa.table({
        "bucket": np.full(p.block, 7), "left": zeros, "right": zeros, "side": zeros, "signature": pa.array([s for s, _ in made], pa.binary()),
        "bands": pa.array([b for _, b in made], pa.list_(pa.int64())),
    })
    tracemalloc.start()
    found = sum(len(i) for i, _, _ in minhash._within_reach(table, np.zeros(1, np.int64), p))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == p.block * (p.block - 1) // 2
    assert peak < 40e6


def test_common_members_of_sorted_sets():
    rng = np.random.default_rng(1)
    for _ in range(50):
        one, two = (np.unique(rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint64)) for _ in range(2))
        assert minhash.common(one, two) == len(set(one.tolist()) & set(two.tolist()))


def test_few_word_hashes_are_held():
    table, words = WordHashes(3), ["a", "b", "c", "d", "e", "a"]
    assert [table[w] for w in words] == [WordHashes()[w] for w in words]
    assert len(table) <= 3
