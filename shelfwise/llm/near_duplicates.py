"""Classes of near-duplicate documents by ProbMinHash, banding and verification.

The elements of a document are its five-word shingles, weighted by how often they
occur. Each element has a Poisson process of its weight's rate, whose arrivals go
to random registers of the signature; a register keeps the element that arrives
first. Elements stop once their next arrival is later than every register's, so
long texts cost little more than one arrival an element. Two signatures agree in
a register with the probability Jaccard similarity of the documents.

Bands of registers put documents into buckets. In each bucket the document that
shares most buckets with others is compared with all members by exact similarity.
Documents that are still in different components, though they share a bucket, are
then compared in blocks, so that no component is lost to the choice of the leader.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import forget_made, map_text, materialize, prepare, string_type
from shelfwise.llm.components import components
from shelfwise.llm.shingles import content_keys, mix, shingles, word_hashes

SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Members that one copy of a leader's text serves, and documents in a block.
LEADER_MEMBERS = 500
BLOCK = 512
#: A pair is verified unless its signatures agree by this many deviations too little.
DEVIATIONS = 4
#: Characters that are hashed at once.
STEP_CHARS = 2_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def signatures(number: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash signatures, one row of 32-bit numbers for each of n documents."""
    earliest = np.full(n * REGISTERS, np.inf)
    found = np.zeros(n * REGISTERS, np.uint32)
    latest = np.full(n, np.inf)
    time, rate = np.zeros(len(element)), weight.astype(np.float64)
    name = mix(element + np.uint64(1)).astype(np.uint32)
    step = 0
    while len(element):
        step += 1
        draw = mix(element + np.uint64(step * int(_GOLDEN) % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        going = time < latest[number]
        element, number, name, time, rate = (x[going] for x in (element, number, name, time, rate))
        register = ((mix(draw[going] ^ _GOLDEN) >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        slot = number * REGISTERS + register.astype(np.int64)
        np.minimum.at(earliest, slot, time)
        first = time == earliest[slot]
        found[slot[first]] = name[first]
        latest = earliest.reshape(n, REGISTERS).max(1)
    return found.reshape(n, REGISTERS)


def bands(signature: np.ndarray) -> np.ndarray:
    """Bucket numbers, BANDS for each document."""
    rows = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    hashes = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(signature), 1), np.uint64)
    for k in range(ROWS):
        hashes = mix(hashes * _GOLDEN + rows[:, :, k] + np.uint64(k))
    return hashes.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets, each (sorted elements, weights).

    The sum, over common elements d, of 1 / sum over d' of max(A[d'] / A[d], B[d'] / B[d]).
    Ordered by the ratio B / A, the maximum changes side once, at d itself.
    """
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    alone_a, alone_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    from_a = alone_a + np.cumsum(x)
    from_b = alone_b + y.sum() - np.cumsum(y)
    return float((1.0 / (from_a / x + from_b / y)).sum())


def _steps(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about STEP_CHARS characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= STEP_CHARS or i == len(texts) - 1:
            yield slice(first, i + 1)
            first, size = i + 1, 0


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    forget_made()
    for batch in batches:
        all_texts, given = batch.column(3).to_pylist(), batch.columns[:3]
        for part in _steps(all_texts):
            texts, own_columns = all_texts[part], [c[part.start : part.stop] for c in given]
            words, offsets = word_hashes(texts)
            high, low = (k.copy() for k in content_keys(words, offsets))
            empty = np.flatnonzero(np.diff(offsets) == 0)
            for i in empty:
                # no words: copies are equal texts; a null text is like no other row
                own = b"\0" + str(own_columns[0][i]).encode() if texts[i] is None else b"\1" + texts[i].encode("utf-8", "surrogatepass")
                high[i], low[i] = np.frombuffer(hashlib.blake2b(own, digest_size=16).digest(), np.int64)
            found = signatures(*shingles(words, offsets), len(texts))
            buckets: list = list(bands(found))
            raw: list = [row.tobytes() for row in found]
            for i in empty:
                buckets[i], raw[i] = None, None
            yield [*own_columns, high, low, raw, buckets]


def _weighted(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weighted shingles of each text."""
    number, element, weight = shingles(*word_hashes(texts))
    cuts = np.searchsorted(number, np.arange(len(texts) + 1))
    return [(element[a:b], weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _compare(threshold: float):
    """Members against the leader before them, in rows sorted by leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        forget_made()
        leader, own = None, None
        for batch in batches:
            groups, ids, kinds, texts = (batch.column(i).to_pylist() for i in range(4))
            left, right = [], []
            for part in _steps(texts):
                for g, i, k, w in zip(groups[part], ids[part], kinds[part], _weighted(texts[part])):
                    if k == 0:
                        leader, own = g, w
                    elif leader == g and similarity(own, w) >= threshold:
                        left.append(g)
                        right.append(i)
            yield [left, right]

    return run


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Those of the pairs (leader, id) whose texts (id, text) are similar, as (a, b).

    Each leader's text is sent ahead of its members, once for each LEADER_MEMBERS
    of them, so a leader of a third of all rows is compared in many tasks.
    """
    kind = texts.schema["id"].dataType
    shares = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / LEADER_MEMBERS).cast("int").alias("shares"))
    ahead = (
        shares.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .join(texts.select(F.col("id").alias("leader"), "text"), "leader")
        .select("leader", "share", F.lit(0).alias("kind"), F.col("leader").alias("id"), "text")
    )
    members = (
        pairs.join(shares, "leader")
        .withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
        .join(texts.select("id", "text"), "id")
        .select("leader", "share", F.lit(1).alias("kind"), "id", "text")
    )
    rows = (
        ahead.union(members)
        .repartition("leader", "share")
        .sortWithinPartitions("leader", "share", "kind")
        .select(F.col("leader").cast("string"), F.col("id").cast("string"), "kind", "text")
    )
    found = map_text(rows, _compare(threshold), "a string, b string")
    return found.select(F.col("a").cast(kind), F.col("b").cast(kind))


def _block_links(threshold: float):
    """Links between different components in the rows of a block.

    Pairs whose signatures agree enough are compared by exact similarity, unless
    links found in this block already connect them; so a block of n documents
    gives n - 1 links at most.
    """
    least = (threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / REGISTERS)) * REGISTERS

    def links_of(rows: list[tuple]) -> tuple[list, list]:
        band, leader = rows[0][1], rows[0][2]
        ids, labels, blocks, texts = ([r[k] for r in rows] for k in (3, 4, 5, 7))
        one = np.array(blocks) == min(blocks)
        first, second = (np.arange(len(rows)),) * 2 if one.all() else (np.flatnonzero(one), np.flatnonzero(~one))
        number = np.unique(labels, return_inverse=True)[1]
        parent = list(range(len(rows)))
        signs = np.frombuffer(b"".join(r[6] for r in rows), np.uint32).reshape(len(rows), REGISTERS)
        lead = np.array([i == leader for i in ids])
        pairs = []
        for i in first[~lead[first]]:
            others = second[second > i] if one.all() else second
            others = others[(number[others] != number[i]) & ~lead[others]]
            equal = signs[others] == signs[i]
            good = equal.sum(1) >= least
            shared = equal[good].reshape(-1, BANDS, ROWS).all(2)
            # a pair counts in its first common band
            pairs += [(i, j) for j in others[good][shared.argmax(1) == band]]
        needed = sorted({k for pair in pairs for k in pair})
        needed_texts = [texts[k] for k in needed]
        sets = dict(zip(needed, (w for part in _steps(needed_texts) for w in _weighted(needed_texts[part]))))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        left, right = [], []
        for i, j in pairs:
            x, y = find(int(number[i])), find(int(number[j]))
            if x != y and similarity(sets[i], sets[j]) >= threshold:
                parent[x] = y
                left.append(ids[i])
                right.append(ids[j])
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        forget_made()
        held: list[tuple] = []
        for batch in batches:
            left, right = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    found = links_of(held)
                    left += found[0]
                    right += found[1]
                    held = []
                held.append(row)
            yield [left, right]
        if held:
            yield list(links_of(held))

    return run


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (leader, id) whose documents lie in different components."""
    of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"))
    label = lambda name: F.coalesce(f"{name}_label", name)
    found = pairs.join(of("id"), "id", "left").join(of("leader"), "leader", "left")
    return found.where(label("id") != label("leader")).select("leader", "id")


def _open_links(live: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of documents that share a bucket, were not compared yet and lie in different components.

    A bucket of many documents is dealt into blocks, and every two blocks meet in
    one group of at most twice BLOCK rows.
    """
    kind = live.schema["id"].dataType
    rows = live.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = (
        rows.groupBy("band", "bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
        .where("n > 2 AND lo < hi")
        .select("band", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = (
        rows.join(mixed, ["band", "bucket"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(texts, "id")
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .repartition("band", "bucket", "lo", "hi")
        .sortWithinPartitions("band", "bucket", "lo", "hi")
        .select(
            F.concat_ws(",", "band", "bucket", "lo", "hi").alias("place"),
            "band",
            F.col("leader").cast("string"),
            F.col("id").cast("string"),
            F.col("label").cast("string"),
            "block",
            "signature",
            "text",
        )
    )
    found = map_text(rows, _block_links(threshold), "a string, b string")
    return found.select(F.col("a").cast(kind), F.col("b").cast(kind))


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (id, text, hash): the hash is of both."""
    docs = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return docs.withColumn("hash", F.xxhash64(F.col("id").cast("string"), "text"))


def _classed(df: DataFrame, key: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Members (row, id, hash, high, low, node) and classes of nodes (node, label, class_id)."""
    prepare(df.sparkSession)
    id_type = df.schema[key].dataType
    docs = _hashed(df, key, text)
    signed = map_text(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("string"), "hash", "text"),
        _sign,
        "row bigint, id string, hash bigint, high bigint, low bigint, signature binary, buckets array<bigint>",
    )
    # The numbers of rows are written: they name the nodes, one for each content.
    signed = materialize(signed.withColumn("id", F.col("id").cast(id_type)), "signatures")
    copies = materialize(
        signed.groupBy("high", "low").agg(F.min("row").alias("node"), F.min("id").alias("least")), "copies"
    )
    members = signed.select("row", "id", "hash", "high", "low").join(copies.drop("least"), ["high", "low"])
    members = materialize(members, "members")
    nodes = signed.where("buckets IS NOT NULL").join(copies.select(F.col("node").alias("row")), "row", "left_semi")
    signed = materialize(nodes.select(F.col("row").alias("id"), F.col("id").alias("doc"), "hash", "signature", "buckets"), "nodes")
    rows = signed.select("id", F.posexplode("buckets").alias("band", "bucket"))
    shared = rows.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = materialize(rows.join(shared, ["band", "bucket"]), "buckets")
    # the document in most company leads: of copies of one original, that is the original
    company = live.groupBy("id").agg(F.sum("n").alias("company"))
    leaders = (
        live.join(company, "id")
        .groupBy("band", "bucket")
        .agg(F.min(F.struct((-F.col("company")).alias("order"), F.col("id"))).alias("first"))
        .select("band", "bucket", F.col("first.id").alias("leader"), F.col("first.order").alias("order"))
    )
    live = materialize(live.join(leaders, ["band", "bucket"]), "led-buckets")
    pairs = live.where("id <> leader").groupBy("id", "leader").agg(F.first("order").alias("order"))
    pairs = materialize(pairs, "pairs")
    # The texts of all nodes in shared buckets. A shuffle at every size: their ids
    # have no bound that a broadcast could rely on.
    signs = signed.select("id", "doc", "hash", "signature").join(live.select("id").distinct(), "id", "left_semi")
    texts = docs.withColumnRenamed("id", "own").join(signs.hint("merge"), "hash").where("own <=> doc")
    # of repeated rows one is read; they lie together already
    texts = materialize(texts.dropDuplicates(["hash", "id"]).select("id", "text", "signature"), "texts")
    # first against one leader each; then against the others that are not in the same component yet
    best = pairs.groupBy("id").agg(F.min(F.struct("order", "leader")).alias("best"))
    best = materialize(best.select("id", F.col("best.leader").alias("leader")), "best-pairs")
    links = materialize(verify(best, texts, threshold), "links")
    labels = materialize(components(links), "labels")
    more = materialize(_apart(pairs.select("id", "leader").join(best, ["id", "leader"], "left_anti"), labels), "pairs")
    if not more.isEmpty():
        links = links.union(materialize(verify(more, texts, threshold), "links"))
        labels = materialize(components(links), "labels")
    rest = materialize(_open_links(live, labels, texts, threshold), "links")
    if not rest.isEmpty():
        labels = components(links.union(rest))
    named = copies.select("node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = materialize(named, "named")
    ids = named.groupBy("label").agg(F.min("least").alias("class_id"))
    return members, named.join(ids, "label").select("node", "label", "class_id")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """Rows (key, class_id), one for each row of ``df``.

    Two texts are linked when the exact probability Jaccard of their five-word
    shingles is ``threshold`` or more; a class is a connected component, named by
    its least key. Texts with the same words are one document from the start;
    a text of one to four words is a single shingle. Texts without words are in
    a class with texts equal to them; a row with a null text is alone. A key says
    nothing about the text: rows with the same key and different texts may lie in
    different classes. A class of null keys alone has a null name. An empty table
    gives no rows.

    At the threshold a pair shares no band with a probability of 5e-5, and less
    the more similar it is.
    """
    members, named = _classed(df, key, text, threshold)
    return members.join(named, "node").select(F.col("id").alias(key), "class_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all columns: the one with the least key, nulls last, then the least content.

    Of rows equal in key and text one stays.
    """
    members, named = _classed(df, key, text, threshold)
    order = F.struct(F.col("id").isNull().alias("null"), "id", "high", "low", "hash")
    first = members.groupBy("node").agg(F.min(order).alias("first")).join(named.select("node", "label"), "node")
    kept = first.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.hash").alias(HASH), F.col("first.id").alias(OWN))
    marked = df.withColumn(HASH, F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`").cast("string")))
    same = (marked[HASH] == kept[HASH]) & marked[key].eqNullSafe(kept[OWN])
    chosen = marked.join(kept.distinct(), same, "left_semi")
    return chosen.dropDuplicates([HASH, key]).drop(HASH)


HASH, OWN = "_near_hash", "_near_key"
