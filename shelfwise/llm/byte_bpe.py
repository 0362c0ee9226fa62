"""Byte-level BPE by backtracking over longest matches.

Every piece of the splitting pattern is encoded separately. The bytes of a piece
are read as Latin-1 characters by an Aho-Corasick automaton over the vocabulary,
which gives all tokens at every place. A token sequence is the result of the
merges if and only if every pair of neighbours is the result for its own bytes,
so a search takes the longest token that is compatible with the one before it,
and steps back where none is. Places that turned out to be dead ends are
remembered, so every place is visited once and the time is linear in the length.
Which pairs are compatible is worked out once and kept.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, map_text, sha_hex, string_type
from shelfwise.llm.pieces import is_plain, plain_splitter

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pieces whose result a task keeps, and the longest piece worth keeping.
KEPT_PIECES = 200_000
KEPT_BYTES = 64
KEPT_PAIRS = 200_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 token, blank, rank."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class _Pieces(dict):
    """Ids of short pieces, as bytes; worked out when first asked for."""

    def __init__(self, codec: ByteBpe):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        ids = array("I", self.codec.encode_bytes(raw)).tobytes()
        if len(raw) <= KEPT_BYTES:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.plain_split = plain_splitter() if pattern == public_tokenizers.PATTERN else self.split
        self.pieces = _Pieces(self)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()

    def merge(self, raw: bytes, below: int = 1 << 30) -> list[bytes]:
        """The merges as defined, of ranks under ``below``, lowest first."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this one joined; None for a single byte."""
        if token not in self.parts:
            found = self.merge(self.tokens[token], token)
            self.parts[token] = (self.ranks[found[0]], self.ranks[found[1]]) if len(found) == 2 else None
        return self.parts[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens as they are when they meet.

        The merges of both are taken back, latest first. At each step the tokens
        that then touched must not have had a merge of their own that came
        earlier; of two merges of one rank the one further left comes first.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        tokens, ranks = self.tokens, self.ranks
        a, b, known = left, right, True
        limit = 1 << 30  # a merge across the border that came before this rank spoils the pair
        while known:
            across = ranks.get(tokens[a] + tokens[b], 1 << 30)
            if across < limit:
                known = False
                break
            in_a, in_b = self.halves(a), self.halves(b)
            if in_a is None and in_b is None:
                break
            if in_b is None or (in_a is not None and a > b):
                limit, a = a, in_a[1]
            else:
                limit, b = b + 1, in_b[0]
        self.pairs[left, right] = known
        return known

    def encode_bytes(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        starts: list[list] = [[] for _ in range(n)]  # (length, token) at each place, shortest first
        for end, token in self.automaton.iter(raw.decode("latin-1")):
            starts[end - token[0] + 1].append(token)
        dead = bytearray(n + 1)
        pairs, compatible = self.pairs, self.compatible
        found: list[int] = []
        steps: list[tuple[int, int]] = []  # where each found token starts, how many of its place are used up
        at, used, last = 0, 0, -1
        while at < n:
            options = starts[at]
            for k in range(len(options) - 1 - used, -1, -1):
                length, token = options[k]
                if dead[at + length]:
                    continue
                if last >= 0:
                    fits = pairs.get((last, token))
                    if not (compatible(last, token) if fits is None else fits):
                        continue
                found.append(token)
                steps.append((at, len(options) - k))
                at, used, last = at + length, 0, token
                break
            else:
                # One valid path at most leads to a place, so a dead end here is one for all.
                if not found:
                    raise ValueError("the vocabulary cannot spell these bytes")
                dead[at] = 1
                found.pop()
                at, used = steps.pop()
                last = found[-1] if found else -1
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, each as four bytes, lowest first."""
        if not text:
            return b""
        split = self.plain_split if is_plain(text) else self.split
        return b"".join(map(self.pieces.__getitem__, split(text)))

    def decode(self, ids: bytes) -> bytes:
        """Bytes that ids stand for."""
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.tokens.__getitem__, numbers))


def build_codec(rank_file: bytes) -> ByteBpe:
    """The codec of a rank file."""
    return ByteBpe(read_ranks(rank_file))


def _send(df: DataFrame, rank_file: str) -> Sent:
    """The rank file for the executors: the size of a vocabulary, whatever the input."""
    with open(rank_file, "rb") as file:
        return Sent(df.sparkSession, file.read())


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """Rows (key, ids): the ids of each whole text as little-endian 32-bit numbers.

    A null or empty text has no ids; repeated rows stay; other columns are ignored.
    Special tokens are ordinary text. No shuffle.
    """
    sent = _send(df, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        codec = sent.made(build_codec)
        for batch in batches:
            yield [batch.column(0), [codec.encode(t) for t in batch.column(1).to_pylist()]]

    docs = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [text]))
    return map_text(docs, run, "id string, ids binary").select(
        F.col("id").cast(df.schema[key].dataType).alias(key), "ids"
    )


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", rank_file: str = RANK_FILE) -> DataFrame:
    """Rows (key, decoded): the bytes that the ids of each row stand for; null ids stay null."""
    sent = _send(df, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        codec = sent.made(build_codec)
        for batch in batches:
            found = (None if x is None else codec.decode(x) for x in batch.column(1).to_pylist())
            yield [batch.column(0), list(found)]

    rows = df.select(F.col(f"`{key}`").cast("string"), F.col(f"`{ids}`"))
    return map_text(rows, run, "id string, decoded binary").select(
        F.col("id").cast(df.schema[key].dataType).alias(key), "decoded"
    )


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids.

    Both run in the pass that reads the text, so that ids need not leave the worker.
    """
    sent = _send(df, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        codec = sent.made(build_codec)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for t in batch.column(1).to_pylist():
                ids = codec.encode(t)
                n.append(len(ids) // 4)
                ids_sha.append(sha_hex(ids))
                text_sha.append(sha_hex(codec.decode(ids)))
            yield [batch.column(0), n, ids_sha, text_sha]

    docs = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [text]))
    found = map_text(docs, run, "id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    key_column: Column = F.col("id").cast(df.schema[key].dataType).alias(key)
    return found.select(key_column, "n_tokens", "ids_sha256", "decoded_sha256")


def tokenized(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """Rows (key, n_tokens, ids, decoded_sha256): the ids as a list, and the hash of what they decode to."""
    sent = _send(df, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        codec = sent.made(build_codec)
        for batch in batches:
            found = [codec.encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield [batch.column(0), np.diff(offsets).tolist(), ids, [sha_hex(codec.decode(x)) for x in found]]

    docs = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [text]))
    found = map_text(docs, run, "id string, n_tokens bigint, ids array<int>, decoded_sha256 string")
    return found.select(F.col("id").cast(df.schema[key].dataType).alias(key), "n_tokens", "ids", "decoded_sha256")
