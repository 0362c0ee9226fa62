"""Shards of near-equal size that never split a group of equal texts.

Minimax contiguous partition: the groups stand in the order of a hash of their
text, the smallest capacity with which a greedy pass needs no more than the
wanted shards is found by binary search, and the cuts are laid at that capacity.

The driver never sees the groups. It sees a list of segments: runs of groups
with a common hash prefix, 65,536 at first. A capacity is bounded from below by
a greedy pass that may cut inside a segment and from above by one that may not.
Segments in which a cut may fall are split by six more hash bits (one small
aggregate each time) until those that matter hold one group, so the result is
the exact optimum over the groups, while the list stays a few hundred thousand
numbers at any input size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import materialize, prepare

FIRST_BITS = 16
MORE_BITS = 6
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


class Segments:
    """Runs of groups in hash order: first hash, prefix bits, bytes, number of groups."""

    def __init__(self, first: np.ndarray, bits: np.ndarray, size: np.ndarray, groups: np.ndarray):
        order = np.argsort(first, kind="stable")
        self.first, self.bits = first[order], bits[order]
        self.size, self.groups = size[order], groups[order]
        self.ends = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.total = int(self.ends[-1])

    def __len__(self) -> int:
        return len(self.first)

    def reach(self, start: int, capacity: int) -> int:
        """Position after the last whole segment that fits a shard from position ``start``."""
        return int(np.searchsorted(self.ends, self.ends[start] + capacity, "right")) - 1

    def whole_cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts between segments, as positions."""
        cuts, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity)
            cuts.append(at)
        return cuts

    def fluid_cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts, in bytes, that may also fall inside segments of several groups."""
        cuts, at = [], 0
        for _ in range(shards):
            end = min(at + capacity, self.total)
            i = int(np.searchsorted(self.ends, end, "right")) - 1
            if i < len(self) and self.groups[i] == 1:
                end = max(int(self.ends[i]), at)
            at = end
            cuts.append(at)
        return cuts

    def least_capacity(self, shards: int, fluid: bool) -> int:
        """Binary search for the smallest capacity whose greedy pass covers everything."""

        def fits(capacity: int) -> bool:
            if fluid:
                return self.fluid_cuts(capacity, shards)[-1] == self.total
            return self.whole_cuts(capacity, shards)[-1] == len(self)

        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if fits(middle) else (middle + 1, high)
        return low

    def open_segments(self, shards: int) -> np.ndarray:
        """Segments of several groups in which a cut may fall at the best capacity."""
        low, high = self.least_capacity(shards, True), self.least_capacity(shards, False)
        touched = np.zeros(len(self) + 1, bool)
        for first, last in zip(self.whole_cuts(low, shards), self.fluid_cuts(high, shards), strict=True):
            to = int(np.searchsorted(self.ends, last, "right")) - 1
            touched[first : to + 1] = True
        return np.flatnonzero(touched[:-1] & (self.groups > 1))

    def _reachable(self, capacity: int, least: int, shards: int) -> list[np.ndarray]:
        """For each number of shards: positions that so many shards of these sizes end at."""
        n = len(self)
        first = np.searchsorted(self.ends, self.ends - capacity, "left")
        last = np.searchsorted(self.ends, self.ends - least, "right")
        found = [np.zeros(n + 1, bool)]
        found[0][0] = True
        for _ in range(shards):
            count = np.concatenate([[0], np.cumsum(found[-1])])
            found.append(count[np.minimum(last, np.arange(n + 1) + 1)] > count[np.minimum(first, n)])
        return found

    def balanced_cuts(self, shards: int) -> list[int]:
        """Cuts at the best capacity with the smallest shard as large as can be.

        Without the second goal, one huge group would let the greedy pass fill few
        shards and leave others empty. The least size is found by binary search to
        a thousandth of the mean.
        """
        capacity = self.least_capacity(shards, False)
        low, high, step = 0, self.total // shards, max(1, self.total // shards // 1000)
        best = self._reachable(capacity, 0, shards)
        while high - low > step:
            middle = (low + high + 1) // 2
            found = self._reachable(capacity, middle, shards)
            if found[-1][-1]:
                low, best = middle, found
            else:
                high = middle
        cuts, at = [], len(self)
        for k in range(shards - 1, 0, -1):
            a = int(np.searchsorted(self.ends, self.ends[at] - capacity, "left"))
            b = min(int(np.searchsorted(self.ends, self.ends[at] - low, "right")), at + 1)
            options = a + np.flatnonzero(best[k][a:b])
            # of the allowed places the one nearest to an even share of what is left
            at = int(options[np.abs(self.ends[options] - self.ends[at] * k / (k + 1)).argmin()])
            cuts.append(at)
        return cuts[::-1]


def _ordered_hash(text: Column) -> Column:
    """64-bit text hash as a signed number that sorts like the unsigned one."""
    return F.xxhash64(text).bitwiseXOR(F.lit(-(2**63)))


def _prefix(hash_: Column, bits: int) -> Column:
    """First bits of the unsigned hash."""
    unsigned = hash_.bitwiseXOR(F.lit(-(2**63)))
    return F.shiftrightunsigned(unsigned, 64 - bits) if bits < 64 else hash_


def _segments(groups: DataFrame, bits: int) -> Segments:
    """Sums of the groups by hash prefix; at most 2**FIRST_BITS rows at first, then those asked for."""
    rows = (
        groups.groupBy(_prefix(F.col("hash"), bits).alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups"), F.min("hash").alias("first"))
        .collect()
    )
    pick = lambda name: np.array([r[name] for r in rows], np.int64)
    return Segments(pick("first"), np.full(len(rows), bits), pick("bytes"), pick("groups"))


def cut_hashes(groups: DataFrame, shards: int) -> list[int | None]:
    """First hash of each shard but the first; None where no group is left for it.

    ``groups`` has one row for each distinct hash: hash, bytes.
    """
    found = _segments(groups, FIRST_BITS)
    if not len(found):
        return [None] * (shards - 1)
    while len(open_ := found.open_segments(shards)):
        keep = np.ones(len(found), bool)
        keep[open_] = False
        parts = [(found.first[keep], found.bits[keep], found.size[keep], found.groups[keep])]
        for bits in np.unique(found.bits[open_]):
            firsts = found.first[open_][found.bits[open_] == bits]
            # at most a few thousand prefixes: those that the cuts may touch
            wanted = groups.sparkSession.createDataFrame([(int(x),) for x in firsts], "first bigint")
            wanted = wanted.select(_prefix(F.col("first"), int(bits)).alias("prefix"))
            touched = groups.withColumn("prefix", _prefix(F.col("hash"), int(bits))).join(
                F.broadcast(wanted), "prefix", "left_semi"
            )
            finer = _segments(touched, min(64, int(bits) + MORE_BITS))
            parts.append((finer.first, finer.bits, finer.size, finer.groups))
        found = Segments(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    return [int(found.first[c]) if c < len(found) else None for c in found.balanced_cuts(shards)]


def shard_documents(df: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into a shard, sizes near equal, equal texts together.

    Rows: key, size (UTF-8 bytes plus ``ROW_BYTES``), text_crc32, law, shard,
    slot (gapless in its shard), grown_shard (null: this law moves rows when the
    number of shards changes). A null text counts as empty and stands with the
    empty ones. Repeated rows are rows of their own, a null key sorts first, an
    empty table gives no rows; other columns are ignored.

    The texts are read once; what follows moves 32 bytes a row. A group that
    holds a third of all rows is summed before the shuffle, and its rows are
    range-partitioned by key, so it lies in many tasks.
    """
    prepare(df.sparkSession)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = materialize(
        df.select(
            F.col(f"`{key}`").alias("id"),
            (F.octet_length(body) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            _ordered_hash(body).alias("hash"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("hash").agg(F.sum("size").alias("bytes")), "shard-groups")
    bounds = [b for b in cut_hashes(groups, shards) if b is not None]
    steps = " + ".join(f"int(hash >= {b}L)" if b > -(2**63) else "1" for b in bounds) or "0"
    placed = (
        rows.withColumn("shard", F.expr(f"int({steps})"))
        .repartitionByRange("shard", "hash", "id")
        .sortWithinPartitions("shard", "hash", "id")
        .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    )
    placed = materialize(placed, "shard-slots")
    # one row for each partition, and one more for each shard border
    runs = placed.groupBy("shard", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(runs), ["shard", "part"]).select(
        F.col("id").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first") + F.col("before")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
