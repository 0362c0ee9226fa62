import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.sharding import ROW_BYTES, Segments, _ordered_hash, shard_documents

from .conftest import ODD


def least_capacity(sizes, shards):
    """Smallest capacity, tried one by one from the obvious bound."""
    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        used, load = 1, 0
        for s in sizes:
            if load + s > capacity:
                used, load = used + 1, 0
            load += s
        if used <= shards:
            return capacity
        capacity += 1


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_the_least(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 60, 200)
    if seed % 2:
        sizes[57] = 3000
    s = Segments(np.arange(200), np.full(200, 64), sizes, np.ones(200, np.int64))
    assert s.least_capacity(7, False) == s.least_capacity(7, True) == least_capacity(sizes.tolist(), 7)
    cuts = [0, *s.balanced_cuts(7), 200]
    loads = [sizes[a:b].sum() for a, b in zip(cuts, cuts[1:])]
    assert max(loads) <= least_capacity(sizes.tolist(), 7)
    assert min(loads) > 0.5 * sorted(loads)[-2]


def test_segments_are_split_until_exact():
    """Runs of groups bound the capacity from both sides; the open ones are those at cuts."""
    coarse = Segments(np.arange(4), np.full(4, 16), np.array([10, 20, 5, 25]), np.array([3, 1, 2, 4]))
    assert coarse.least_capacity(3, True) <= coarse.least_capacity(3, False)
    assert set(coarse.open_segments(3)) <= {0, 2, 3}


def check(rows, df, shards):
    got = df.collect()
    assert len(got) == len(rows)
    where, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        assert any(r["size"] == len((t or "").encode()) + 16 and r["text_crc32"] == zlib.crc32((t or "").encode()) for t in texts[r["doc_id"]])
        where[r["size"], r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


@pytest.mark.parametrize("shards", [3, 5, 40])
def test_largest_shard_is_the_optimum(small, shards):
    """Against the capacity found one by one over the groups of equal texts in hash order."""
    body = F.coalesce("text", F.lit(""))
    groups = small.groupBy(_ordered_hash(body).alias("h")).agg(F.sum(F.octet_length(body) + ROW_BYTES).alias("n"))
    sizes = [r["n"] for r in groups.orderBy("h").collect()]
    load = defaultdict(int)
    for r in shard_documents(small, shards).collect():
        load[r["shard"]] += r["size"]
    assert sum(load.values()) == sum(sizes) and max(load.values()) == least_capacity(sizes, shards)


def test_small_table(small, small_rows):
    load = check(small_rows, shard_documents(small, 5), 5)
    assert max(load.values()) < 1.25 * sum(load.values()) / 5


def test_hot_group_and_odd_rows(make):
    check(ODD, shard_documents(make(ODD), 8), 8)
    rows = [(100 + i, "hot text " * 40) for i in range(3000)] + [(5000 + i, f"own text {i} " * 5) for i in range(3000)]
    load = check(rows, shard_documents(make(rows), 8), 8)
    others = sorted(load.values())[:-1]
    assert min(others) > 0.5 * max(others)


def test_empty_table(make):
    assert shard_documents(make([]), 40).collect() == []
