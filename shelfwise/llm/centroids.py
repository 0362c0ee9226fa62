"""Centroid clustering with a progressive search in the Walsh-Hadamard domain.

Vectors become integers and are transformed exactly. The transform keeps distances
up to the factor 64 and gathers most of them in its first, coarse coefficients, so
the search adds squared differences coarse to fine and drops a centroid as soon as
its sum exceeds the whole distance of another one. What stays is summed over all 64
coefficients, so the nearest centroid is exact.

The transform is linear: sums of clusters are summed as coefficients and turned
back on the driver, which sees one row for each centroid and limb of its sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_text, materialize, prepare, sha_hex

SIZE = 64
CENTROIDS, ROUNDS, SCALE, SEED = 8, 10, 1024, 3
#: Coefficients added at a time, coarse to fine; the leader is finished after the fourth step.
STEPS = ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16), (16, 32), (32, 64))
LEAD = 8
#: Coefficients up to this size give squared distances that 64-bit sums hold.
NARROW = 1 << 27
#: Bits of a limb of the sums that leave a task.
LIMB = 40
#: Vectors that are searched at once.
BLOCK = 8_192
LONG_MAX = (1 << 63) - 1


def _order() -> np.ndarray:
    """Natural place of the k-th Walsh function from coarse to fine: its bits reversed."""
    bits = SIZE.bit_length() - 1
    return np.array([int(f"{k:0{bits}b}"[::-1], 2) for k in range(SIZE)])


ORDER = _order()


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse to fine; twice gives ``SIZE`` times the rows."""
    found = rows.copy()
    half = 1
    while half < SIZE:
        pairs = found.reshape(len(rows), -1, 2, half)
        found = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(rows.shape)
        half *= 2
    return found[:, ORDER]


def back(coefs: np.ndarray) -> np.ndarray:
    """The integer rows of coefficients, times ``SIZE``."""
    natural = np.empty_like(coefs)
    natural[:, ORDER] = coefs
    return transform(natural)[:, np.argsort(ORDER)]


def floored(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exact for every finite double."""
    return int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)


def packed(coefs: np.ndarray) -> list[bytes]:
    """Rows as little-endian signed numbers, 4 bytes each or as many as the largest needs."""
    if coefs.dtype != object:
        return [row.tobytes() for row in coefs.astype("<i4")]
    found = []
    for row in coefs:
        width = max(8, max(int(c).bit_length() for c in row) // 8 + 1)
        found.append(b"".join(int(c).to_bytes(width, "little", signed=True) for c in row))
    return found


def unpacked(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places and coefficients of the narrow rows, and those of the others, as Python numbers."""
    narrow = np.array([len(r) == 4 * SIZE for r in rows], bool)
    small = np.frombuffer(b"".join(r for r in rows if len(r) == 4 * SIZE), "<i4").reshape(-1, SIZE).astype(np.int64)
    others = [r for r in rows if len(r) != 4 * SIZE]
    wide = np.empty((len(others), SIZE), object)
    for i, r in enumerate(others):
        step = len(r) // SIZE
        wide[i] = [int.from_bytes(r[j : j + step], "little", signed=True) for j in range(0, len(r), step)]
    return np.flatnonzero(narrow), small, np.flatnonzero(~narrow), wide


def nearest(coefs: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row (the smaller of equals), and ``SIZE`` times its squared distance."""
    n, k = len(coefs), len(centres)
    row, which = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    sums = np.zeros(n * k, coefs.dtype)
    bound = None
    for a, b in STEPS:
        gap = coefs[row, a:b] - centres[which, a:b]
        sums = sums + (gap * gap).sum(1)
        if b == LEAD:
            lead = sums.reshape(n, k).argmin(1)
            gap = coefs[:, LEAD:] - centres[lead, LEAD:]
            bound = sums.reshape(n, k)[np.arange(n), lead] + (gap * gap).sum(1)
        if bound is not None and b < SIZE:
            keep = sums <= bound[row]
            row, which, sums = row[keep], which[keep], sums[keep]
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(sums, starts)
    first = np.flatnonzero(sums == least[row])
    first = first[np.unique(row[first], return_index=True)[1]]
    return which[first], least


def assigned(rows: list[bytes], centres: list[list[int]]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Cluster and squared distance of packed rows, and the rows' coefficients."""
    exact = np.array(centres, object)
    small_places, small, wide_places, wide = unpacked(rows)
    cluster, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), object)
    coefs = np.empty((len(rows), SIZE), object) if len(wide) else small
    fits = max(abs(c) for centre in centres for c in centre) <= NARROW
    for places, part in ((small_places, small), (wide_places, wide)):
        if len(part):
            plain = fits and part.dtype != object
            part = part if plain else part.astype(object)
            cluster[places], found = nearest(part, exact.astype(np.int64) if plain else exact)
            distance[places] = found // SIZE
            if len(wide):
                coefs[places] = part
    return cluster, [int(d) for d in distance], coefs


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to blocks of ``BLOCK`` rows or more."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def coefficients(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id, coefs) of the vectors that are kept, transformed and packed."""
    value = F.col(f"`{vector}`").cast("array<double>")
    whole = (F.size(value) == SIZE) & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            small = (np.abs(values) * SCALE <= NARROW // SIZE - 1).all(1)
            plain = packed(transform(np.floor(values[small] * SCALE).astype(np.int64)))
            huge = [[floored(float(x)) for x in row] for row in values[~small]]
            wide = packed(transform(np.array(huge, object))) if huge else []
            found = np.empty(len(values), object)
            found[small], found[~small] = plain, wide
            yield [batch.column(0), found.tolist()]

    kept = df.where(whole).select(F.col(f"`{key}`").cast("bigint"), value)
    return map_text(kept, run, "id bigint, coefs binary")


def first_centres(stored: DataFrame, k: int, seed: int) -> list[list[int]]:
    """Coefficients of the k vectors first by the hash of their id; null ids last, of equal ids by content."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = stored.orderBy(F.asc_nulls_last(order), "coefs").limit(k).collect()
    found = []
    for r in rows:
        _, small, _, wide = unpacked([bytes(r["coefs"])])
        found.append([int(c) for c in (small if len(small) else wide)[0]])
    return found


def moved(stored: DataFrame, centres: list[list[int]]) -> list[list[int]]:
    """Coefficients of the centroids after one round; those of empty clusters stay.

    A task sums its clusters over all its rows. Sums leave it in limbs of ``LIMB``
    bits, signed in the last, so that sums of any size are exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        count, total = [0] * len(centres), np.zeros((len(centres), SIZE), object)
        for block in _blocks(batches):
            cluster, _, coefs = assigned(block.column(0).to_pylist(), centres)
            for c in np.unique(cluster):
                part = coefs[cluster == c]
                count[c] += len(part)
                total[c] += part.sum(0).astype(object)
        out = []
        for c, n in enumerate(count):
            rest, limb = [int(x) for x in total[c]], 0
            while n and (limb == 0 or any(rest)):
                last = all(-(1 << LIMB) < x < (1 << LIMB) for x in rest)
                low = rest if last else [x & ((1 << LIMB) - 1) for x in rest]
                out.append((c, limb, 0 if limb else n, low))
                rest, limb = [0] * SIZE if last else [x >> LIMB for x in rest], limb + 1
        if out:
            yield list(zip(*out))

    parts = map_text(stored.select("coefs"), run, "cluster int, limb int, n bigint, sums array<bigint>")
    sums = parts.select("cluster", "limb", "n", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "limb", "place")
    count, total = [0] * len(centres), np.zeros((len(centres), SIZE), object)
    for c, limb, place, n, x in sums.agg(F.sum("n"), F.sum("x")).collect():
        count[c] = max(count[c], n)  # the rows of limb 0 bear the number of vectors
        total[c, place] += x << LIMB * limb
    found = [list(c) for c in centres]
    for c, n in enumerate(count):
        if n:
            mean = np.array([[x // SIZE // n for x in back(total[c : c + 1])[0]]], object)
            found[c] = [int(x) for x in transform(mean)[0]]
    return found


def clusters(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """Rows (key, cluster, distance, cluster_inertia, inertia, centroid_sha256), one for each vector that is kept.

    Kept are vectors of 64 components, none of them null, NaN or infinite. Fewer
    than ``k`` of them give as many centroids; none give no rows. Repeated ids stay
    apart; a null id starts no centroid unless others are wanting. A distance or
    an inertia that a long cannot hold is null, the assignment is exact all the
    same. Other columns are ignored.

    The coefficients are written once; each round is one scan of them.
    """
    prepare(df.sparkSession)
    stored = materialize(coefficients(df, key, vector), "coefficients")
    centres = first_centres(stored, k, seed)
    for _ in range(rounds):
        centres = moved(stored, centres) if centres else centres
    shown = [",".join(str(x // SIZE) for x in row) for row in back(np.array(centres, object))] if centres else []
    hashes = [sha_hex(s.encode()) for s in shown]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for block in _blocks(batches):
            cluster, distance, _ = assigned(block.column(1).to_pylist(), centres)
            fits = [d if d <= LONG_MAX else None for d in distance]
            ids = block.column(0).combine_chunks()
            yield [ids, cluster.tolist(), fits, [hashes[c] for c in cluster]]

    # written, so that the sums do not search once more
    found = materialize(map_text(stored, run, "id bigint, cluster int, distance bigint, centroid_sha256 string"), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.count("distance") == F.count(F.lit(1))
    # one row for each centroid
    sums = found.groupBy("cluster").agg(F.when(whole, exact).alias("sum"))
    all_ = Window.partitionBy()
    known = F.count("sum").over(all_) == F.count(F.lit(1)).over(all_)
    sums = sums.withColumn("all", F.when(known, F.sum("sum").over(all_))).selectExpr(
        "cluster", "try_cast(sum AS bigint) AS cluster_inertia", "try_cast(all AS bigint) AS inertia"
    )
    return found.join(F.broadcast(sums), "cluster").select(
        F.col("id").cast(df.schema[key].dataType).alias(key), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256",
    )
