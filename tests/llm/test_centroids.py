import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from shelfwise.llm import centroids, queries, sql
from tests.llm.conftest import SMALL


def brute(rows, k=8, rounds=10, seed=3):
    """The same rounds in plain Python on (vec_id, components) rows with known ids."""
    kept = [(i, [math.floor(1024 * v) if abs(v) < 2**53 else int(v) * 1024 for v in x]) for i, x in rows
            if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()))
    centres = [v for _, v in first[:k]]

    def near(v):
        found = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, v in kept:
            groups[near(v)[0]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == n) for n in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, c, d, inertia[c], sum(inertia), sha[c]) for i, c, d in found)


def vectors(spark, rows):
    data = [(i, None if x is None else [None if v is None else float(v) for v in x]) for i, x in rows]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    return df.selectExpr("*", *(f"'x' AS {c}" for c in ("id", "cluster", "coefs", "distance", "n", "limb")))


def result(df, **params):
    return sorted(map(tuple, centroids.clusters(df, **params).collect()))


def test_transform_is_its_own_inverse():
    rows = np.random.default_rng(1).integers(-1000, 1000, (40, 64))
    assert (centroids.back(centroids.transform(rows)) == 64 * rows).all()
    wide = rows.astype(object) * 10**30
    assert (centroids.back(centroids.transform(wide)) == 64 * wide).all()


def test_first_coefficients_are_the_coarsest():
    """The first 2^k coefficients depend on the sums of 2^k blocks of components only."""
    rows = np.random.default_rng(2).integers(-1000, 1000, (5, 64))
    for k in range(7):
        means = np.repeat(rows.reshape(5, 2**k, -1).sum(2), 64 >> k, axis=1)
        assert (centroids.transform(means)[:, : 2**k] == (64 >> k) * centroids.transform(rows)[:, : 2**k]).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_is_exact(kind):
    r = np.random.default_rng(3)
    rows, centres = r.integers(-300, 300, (200, 64)), r.integers(-300, 300, (8, 64))
    centres[5] = centres[2]
    rows[:20] = centres[2]  # ties at distance 0
    rows[20:30] = (centres[0] + centres[1]) // 2
    square = ((rows[:, None] - centres[None]) ** 2).sum(2)
    cluster, found = centroids.nearest(
        centroids.transform(rows).astype(kind), centroids.transform(centres).astype(kind)
    )
    assert (cluster == square.argmin(1)).all()
    assert (found == 64 * square.min(1)).all()


def test_brute_force(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(i % 5, 1) for _ in range(64)]) for i in range(150)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]  # a hot vector
    assert result(vectors(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    r = random.Random(5)
    good = [(i, [r.uniform(-1, 1) for _ in range(64)]) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63),
           (105, [float("nan")] * 64), (106, [float("inf")] + [0.0] * 63), (107, [-float("inf")] * 64)]
    repeated = [good[3], good[3], (3, good[4][1])]
    assert result(vectors(spark, good + bad)) == brute(good)
    got = result(vectors(spark, good + bad + repeated))
    assert [g[0] for g in got] == sorted(i for i, _ in good + repeated)
    assert result(vectors(spark, bad)) == [] and result(vectors(spark, [])) == []
    assert result(vectors(spark, good[:3])) == brute(good[:3])


def test_null_ids(spark):
    r = random.Random(6)
    rows = [(i if i % 4 else None, [r.uniform(-1, 1) for _ in range(64)]) for i in range(40)]
    got = centroids.clusters(vectors(spark, rows)).collect()
    assert len(got) == 40 and sum(g["vec_id"] is None for g in got) == 10
    alone = centroids.clusters(vectors(spark, [(None, rows[0][1])] * 3)).collect()
    assert [(g["cluster"], g["distance"]) for g in alone] == [(0, 0)] * 3


def test_huge_components(spark):
    """Sums stay exact; what a long cannot hold is null."""
    r = random.Random(7)
    rows = [(i, [r.uniform(-1, 1) * 10.0 ** (i % 4 * 6) for _ in range(64)]) for i in range(40)]
    rows += [(50, [1.7e308] * 64), (51, [-1.7e308] * 64), (52, [3e9] * 64)]
    want = brute(rows)
    top = 2**63
    got = {g[0]: g for g in map(tuple, centroids.clusters(vectors(spark, rows)).collect())}
    for i, c, d, inertia, all_, sha in want:
        assert got[i] == (i, c, *(x if x < top else None for x in (d, inertia, all_)), sha)


def test_float_vectors_and_layouts(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows)
    assert result(df) == want == result(df.repartition(7))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    assert sorted(duck.execute(sql.clusters()).fetchall()) == want
    assert set(queries.oracle_sql()) == {"op11_centroid_clusters"}
