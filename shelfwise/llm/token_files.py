"""Token ids in ORC files.

Documents are range-partitioned by id, sorted, encoded and written as ORC: ids as
integer lists in run-length encoding, a row index in every stripe, Bloom filters
on the document id. Stripes are read in parallel; a look-up by document reads the
stripes that the statistics and filters leave.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from shelfwise.llm.common import Sent, map_text, materialize, prepare, scratch_path, string_type
from shelfwise.llm.pieces import NOT_PLAIN, PieceModel, split_plain

TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Pieces of one generation whose ids a worker keeps, and the longest piece worth keeping.
KEPT_PIECES = 400_000
KEPT_CHARS = 64
#: Bytes of text that are split at once: few distinct pieces for many, and a bounded block.
BLOCK_BYTES = 8 << 20
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}


class _Kept(dict):
    """Ids of pieces as bytes, worked out when first asked for, in two generations.

    What is asked of the older one moves to the newer; long pieces are kept for a
    batch only.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.older: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        long = len(piece) > KEPT_CHARS
        found = (self.long if long else self.older).get(piece)
        if found is None:
            found = array("I", self.model.ids(piece)).tobytes()
        if long:
            self.long[piece] = found
            return found
        if len(self) >= KEPT_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


class PieceTokenizer:
    """A byte-level tokenizer that is asked for each distinct piece once.

    Its merges never cross the pieces of the splitting pattern, so the ids of a
    text are those of its pieces. A block of plain texts (ASCII and Latin-1 letters)
    is split at once and its distinct pieces are numbered by Arrow; other texts are
    split one by one. Texts that hold an added token, which is found before the text
    is split, are encoded whole.
    """

    def __init__(self, json_text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on a core
        self.tokenizer = Tokenizer.from_str(json_text)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "|".join(map(re.escape, added))
        self.has_added = re.compile(self.added, re.IGNORECASE).search if added else lambda text: None
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.kept = _Kept(PieceModel(self.tokenizer))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        lists = self.encode(pa.array(texts, pa.string()), END_ID)
        return [np.asarray(x.values, "<i4")[:-1].tobytes() for x in lists]

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text and ``end_id``, of a null or empty one ``end_id`` alone."""
        self.kept.long.clear()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, NOT_PLAIN)
        if self.added:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.added, ignore_case=True))
        if not pc.any(odd, min_count=0).as_py():
            return self._encode_plain(texts, end_id)
        end = array("I", [end_id]).tobytes()
        apart = _lists([self._encode(t) + end for t in texts.filter(odd).to_pylist()])
        both = pa.concat_arrays([self._encode_plain(texts.filter(pc.invert(odd)), end_id), apart])
        odd = odd.to_numpy(zero_copy_only=False)
        return both.take(pa.array(np.argsort(np.argsort(odd, kind="stable"))))

    def _encode(self, text: str) -> bytes:
        if self.has_added(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.kept.__getitem__, self.split(text)))

    def _encode_plain(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        split = split_plain(texts)
        pieces, ends = split.values.dictionary_encode(), split.offsets.to_numpy()
        found = [self.kept[p] for p in pieces.dictionary.to_numpy(zero_copy_only=False)]
        codes = np.insert(pieces.indices.to_numpy(), ends[1:], len(found))
        ids = _lists([*found, array("I", [end_id]).tobytes()]).take(pa.array(codes))
        ends = ends + np.arange(len(ends), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ids.offsets.to_numpy()[ends]), ids.values)


def _lists(ids: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, ids), np.int32, len(ids)) // 4, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def text_blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in blocks of about ``BLOCK_BYTES`` of text, whatever its rows' lengths."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - size, "right")))
            held.append(batch.slice(start, stop - start))
            size, start = size + int(ends[stop - 1] - before), stop
            if start < len(ends) or size >= BLOCK_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def write_tokens(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer_file: str = TOKENIZER_FILE,
    end_id: int = END_ID,
) -> None:
    """Write the ids of every text, ``end_id`` after each, in ascending order of the key.

    Columns: doc_id, row (order of all rows: partition and place), ids. A null or
    empty text is written as ``end_id`` alone; rows with the same key stand in
    order of a hash of their text, so that they may lie in several partitions; a
    null key comes first. Other columns are ignored.
    """
    spark = prepare(df.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        sent = Sent(spark, file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        tokenizer = sent.made(PieceTokenizer)
        for block in text_blocks(batches, 2):
            yield [block.column(0), block.column(1), tokenizer.encode(block.column(2), end_id)]

    ordered = (
        df.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), *string_type(df, [text]))
        .withColumn("tie", F.xxhash64(text))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", F.monotonically_increasing_id().alias("row"), text)
    )
    map_text(ordered, run, "doc_id bigint, row bigint, ids array<int>").write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as rows (doc_id, row, ids); filters on doc_id reach the stripe indexes."""
    schema = "doc_id bigint, row bigint, ids array<int>"
    return prepare(spark).read.schema(schema).orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of written files, one for each row.

    ``start`` is the number of ids before the document. Sums of whole partitions
    give the first start of each; within one they are summed in row order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(memoryview(ids[a:b])) for a, b in zip(offsets[:-1], offsets[1:])]
            yield [batch.column(0), batch.column(1), np.diff(offsets).astype(np.int64), crc]

    rows = map_text(tokens, run, "doc_id bigint, row bigint, n_tokens bigint, ids_crc32 bigint")
    rows = materialize(rows.withColumn("part", F.shiftright("row", 33)), "token-index")
    # one row for each partition of the writing job
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id",
        (F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_files(df: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Write the files to the shared folder, read them back and index them."""
    spark = df.sparkSession
    path = scratch_path(spark, "token-files")
    write_tokens(df, path, key, text, **params)
    found = token_index(read_tokens(spark, path))
    return found.withColumn("doc_id", F.col("doc_id").cast(df.schema[key].dataType)).withColumnRenamed("doc_id", key)
