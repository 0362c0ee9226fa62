"""Alignment of the tokens of two tokenizers over the same bytes.

Texts are cut before every blank that follows no white space: neither tokenizer
merges across such a place, so a unit (mostly a word with its signs) is tokenized
once in a task and its groups, ids and links serve every text that holds it.

Links between an id of the first tokenizer and the id of the second with the same
bytes are counted in arrays of the length of the first vocabulary. Other links are
counted by pair. The totals of same-bytes links and of the most frequent other
pairs come back as arrays of a proven size; only the remaining links of documents
are shuffled, and no pair among them has more than a small share of all links.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfwise.llm.common import Sent, map_text, materialize, prepare, sha_hex
from shelfwise.llm.pieces import PieceModel, byte_letters, is_plain, plain_splitter

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
#: Units of one of the two generations that a worker keeps.
KEPT_UNITS = 250_000
#: Characters from which a unit is not kept.
LONG = 64
#: Pair counts of a task that leave it at the latest when there are so many.
TASK_PAIRS = 200_000
#: Pairs with more than this share of all links are looked up, not shuffled: there are at most 1 / share of them.
HEAVY_SHARE = 1 / 20_000

CUT = re.compile(r"(?<=\S)(?= )")
BLANK = "▁"


def first_bytes(json_text: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer."""
    vocabulary = json.loads(json_text)["model"]["vocab"]
    letters = byte_letters()
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known = all(c in letters for c in token)
        found[i] = bytes(letters[c] for c in token) if known else token.encode()
    return found


def second_bytes(model: SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id of a piece tokenizer: its text with blanks, or the byte it names."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode())
    return found


class Unit(NamedTuple):
    """What one unit adds to a text: the sizes, the groups as text, the links as 64-bit numbers."""

    n_a: int
    n_b: int
    n_groups: int
    written: str
    links: bytes


class Aligner:
    """Both tokenizers, the same-bytes map, and the units that a worker has met."""

    def __init__(self, given: tuple[str, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on a core
        json_text, model = given
        # Piece by piece, so that the texts of special tokens are ordinary text.
        self.first = PieceModel(Tokenizer.from_str(json_text))
        self.split, self.plain_split = regex.compile(public_tokenizers.PATTERN).findall, plain_splitter()
        self.second = SentencePieceProcessor(model_proto=model)
        self.first_bytes, self.second_bytes = first_bytes(json_text), second_bytes(self.second)
        self.first_sizes, self.second_sizes = (np.array(list(map(len, x))) for x in (self.first_bytes, self.second_bytes))
        self.n_first, self.n_second = len(self.first_bytes), len(self.second_bytes)
        ids = {}
        for i in reversed(range(self.n_second)):  # of several ids with the same bytes the first
            ids[self.second_bytes[i]] = i
        #: id of the second vocabulary with the same bytes, or -1
        self.same = np.array([ids.get(b, -1) for b in self.first_bytes])
        self.blank = self.second.piece_to_id(BLANK)
        #: ids as text before another id of their group, and at the end of their side of it
        self.shown = [f"{i}{c}" for n, end in ((self.n_first, "|"), (self.n_second, ";")) for i in range(n) for c in (",", end)]
        self.new: dict[str, Unit | None] = {}
        self.old: dict[str, Unit | None] = {}

    def units(self, texts: list[list[str]]) -> dict[str, Unit | None]:
        """The units of some texts, each tokenized once; two generations keep those met last.

        None stands for a unit that the ids of either side do not give back.
        """
        found, missing = {}, []
        for u in set().union(*texts):
            if u in self.new:
                found[u] = self.new[u]
            elif u in self.old:
                found[u] = self.new[u] = self.old[u]
            else:
                missing.append(u)
        for u, unit in zip(missing, self.made(missing)):
            found[u] = unit
            if len(u) < LONG:
                self.new[u] = unit
        if len(self.new) > KEPT_UNITS:
            self.old, self.new = self.new, {}
        return found

    def made(self, texts: list[str]) -> list[Unit | None]:
        """New units: each text begins with the blank that the second tokenizer adds."""
        if not texts:
            return []
        split, ids = ((self.plain_split if is_plain(t) else self.split)(t) for t in texts), self.first.ids
        a = [[i for piece in pieces for i in ids(piece)] for pieces in split]
        b = [x or [self.blank] for x in self.second.encode([t[1:] for t in texts], num_threads=1)]
        ok = [self.gives(t.encode("utf-8", "surrogatepass"), x, y) for t, x, y in zip(texts, a, b)]
        units = iter(self.grouped([x for x, good in zip(a, ok) if good], [y for y, good in zip(b, ok) if good]))
        return [next(units) if good else None for good in ok]

    def gives(self, data: bytes, a: list[int], b: list[int]) -> bool:
        """Whether the ids of both sides stand for these bytes."""
        return b"".join([self.first_bytes[i] for i in a]) == data == b"".join([self.second_bytes[i] for i in b])

    def grouped(self, a: list[list[int]], b: list[list[int]]) -> list[Unit]:
        """Units from the ids of their sides, which stand for the same bytes."""
        if not a:
            return []
        sides, ends = [], []
        for lists, sizes in ((a, self.first_sizes), (b, self.second_sizes)):
            ids = np.fromiter(chain.from_iterable(lists), np.int64)
            sides.append(ids)
            ends.append(np.cumsum(sizes[ids]))
        last = [np.isin(ends[0], ends[1]), np.isin(ends[1], ends[0])]
        group = [np.cumsum(m) - m for m in last]
        x, y = sides[0][last[0]], sides[1][last[1]]
        single = (np.bincount(group[0]) == 1) & (np.bincount(group[1]) == 1) & (self.same[x] == y)
        links = np.where(single, x, self.n_first * (1 + y) + x)
        codes = np.concatenate([2 * sides[0] + last[0], 2 * (self.n_first + sides[1]) + last[1]])
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        shown = list(map(self.shown.__getitem__, codes[order].tolist()))
        n_a, n_b = list(map(len, a)), list(map(len, b))
        n_groups = np.add.reduceat(last[0].astype(np.int64), np.cumsum([0, *n_a[:-1]])).tolist()
        found, at, place, data = [], 0, 0, links.tobytes()
        for p, q, n in zip(n_a, n_b, n_groups):
            found.append(Unit(p, q, n, "".join(shown[at : at + p + q]), data[8 * place : 8 * (place + n)]))
            at, place = at + p + q, place + n
        return found


ROWS = "row bigint, id string, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>, times array<bigint>"


def align(df: DataFrame, sent: Sent) -> DataFrame:
    """Rows of ``ROWS`` for each row (row, id, text), and rows without ``row`` that bear the counts of a task.

    ``links`` are distinct: an id of the first vocabulary for a same-bytes link of
    a one-to-one group, else size + second id * size + first id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        aligner = sent.made(Aligner)
        size = aligner.n_first
        span = size * (aligner.n_second + 1)
        same = np.zeros(size, np.int64)
        pairs: dict[int, int] = {}

        def counts():
            used = np.flatnonzero(same)
            links = np.concatenate([used, np.fromiter(pairs.keys(), np.int64, len(pairs))])
            times = np.concatenate([same[used], np.fromiter(pairs.values(), np.int64, len(pairs))])
            same[:] = 0
            pairs.clear()
            return [[None]] * 6 + [[links], [times]]

        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            cut = [CUT.split(" " + t) if t else [] for t in texts]
            known = aligner.units(cut)
            sizes, shas, parts = [], [], []
            for units in cut:
                met = [known[u] for u in units]
                if not met or None in met:
                    sizes.append((0, 0, 0))
                    shas.append("")
                    parts.append(b"")
                    continue
                n_a, n_b, n_groups, written, ends = zip(*met)
                sizes.append((sum(n_a), sum(n_b), sum(n_groups)))
                shas.append(sha_hex("".join(written)[:-1].encode()))
                parts.append(b"".join(ends))
            links = np.frombuffer(b"".join(parts), np.int64)
            place = np.repeat(np.arange(len(parts)), [len(p) // 8 for p in parts])
            cells, times = np.unique(place * span + links, return_counts=True)
            place, links = cells // span, cells % span
            plain = links < size
            np.add.at(same, links[plain], times[plain])
            once, which = np.unique(links[~plain], return_inverse=True)
            for link, n in zip(once.tolist(), np.bincount(which, times[~plain], len(once)).astype(np.int64).tolist()):
                pairs[link] = pairs.get(link, 0) + n
            offsets = np.searchsorted(place, np.arange(len(parts) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (links, times)]
            yield [batch.column(0), batch.column(1), *map(list, zip(*sizes)), shas, *lists]
            if len(pairs) > TASK_PAIRS:
                yield counts()
        if pairs or same.any():
            yield counts()

    return map_text(df.select("row", "id", "text"), run, ROWS)


def pair_counts(aligned: DataFrame, n_first: int, same: list[int]) -> DataFrame:
    """Rows (link, b, n, best): every link between two ids, how often, and whether none is more frequent for b.

    Tokens with the same bytes that end together start together too, so all links
    of same-bytes ids are those of one-to-one groups.
    """
    spark = aligned.sparkSession
    tasks = aligned.where("row IS NULL").select(F.explode(F.arrays_zip("links", "times")).alias("x"))
    links = tasks.groupBy(F.col("x.links").alias("link")).agg(F.sum("x.times").alias("n"))
    # one row for each id of the first vocabulary
    named = spark.createDataFrame([(a, b) for a, b in enumerate(same) if b >= 0], "link bigint, same bigint")
    second = F.coalesce("same", F.floor(F.col("link") / n_first) - 1)
    pairs = materialize(links.join(F.broadcast(named), "link", "left").select("link", second.alias("b"), "n"), "links")
    # one row for each id of the second vocabulary
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(F.broadcast(most), "b").select("link", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _lookup(pairs: DataFrame, n_first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted links of same-bytes pairs and of heavy ones, their counts, and whether they are the best."""
    total = pairs.agg(F.sum("n")).first()[0] or 0
    # at most one row for each id of the first vocabulary, and 1 / HEAVY_SHARE others
    table = pairs.where((F.col("link") < n_first) | (F.col("n") > total * HEAVY_SHARE)).select("link", "n", "best").toArrow()
    links, n, best = (table.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    order = np.argsort(links)
    return links[order], n[order], best[order].astype(bool)


def alignment(
    df: DataFrame, key: str = "doc_id", text: str = "text", first_file: str = FIRST, second_file: str = SECOND
) -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one for each row of ``df``.

    A text that is null, empty or not given back by the bytes of both tokenizers
    has no tokens. A link is the pair of the tokens that end a group, so there are
    as many links as groups. Rows with a repeated or null key stay apart. Other
    columns are ignored.

    The texts are read and tokenized once; the alignment is written to the shared
    folder, with the counts that the tasks made.
    """
    spark = prepare(df.sparkSession)
    with open(first_file, encoding="utf-8") as one, open(second_file, "rb") as two:
        given = (one.read(), two.read())
    aligner = Aligner(given)
    n_first, same = aligner.n_first, aligner.same.tolist()
    sent = Sent(spark, given)
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("string").alias("id"),
                     F.col(f"`{text}`").cast("string").alias("text"))
    aligned = materialize(align(rows, sent), "alignment")
    pairs = materialize(pair_counts(aligned, n_first, same), "pair-counts")
    table = Sent(spark, _lookup(pairs, n_first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        links, n, best = table.broadcast.value
        for batch in batches:
            wanted = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            times = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            place = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(links, wanted), max(0, len(links) - 1))
            hit = links[at] == wanted if len(links) else np.zeros(len(wanted), bool)
            rows = batch.num_rows
            sums, tops = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(sums, place[hit], times[hit] * n[at[hit]])
            np.add.at(tops, place[hit], times[hit] * best[at[hit]])
            rest = place[~hit]
            offsets = np.searchsorted(rest, np.arange(rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit], pa.int64())) for x in (wanted, times)]
            yield [batch.column(0), sums, tops, *lists]

    docs = aligned.where("row IS NOT NULL")
    counted = map_text(
        docs.select("row", "links", "times"), run,
        "row bigint, count_sum bigint, n_best bigint, links array<bigint>, times array<bigint>",
    )
    counted = materialize(counted, "counted")
    light = counted.where(F.size("links") > 0).select("row", F.explode(F.arrays_zip("links", "times")).alias("x"))
    light = light.select("row", F.col("x.links").alias("link"), F.col("x.times").alias("times"))
    light = light.join(pairs.where(F.col("link") >= n_first).select("link", "n", "best"), "link")
    added = light.select(
        "row", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best")
    )
    sums = counted.select("row", "count_sum", "n_best").unionByName(added).groupBy("row")
    sums = sums.agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    found = docs.drop("links", "times").join(sums, "row")
    return found.select(
        F.col("id").cast(df.schema[key].dataType).alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256",
    )
