"""Words of documents that stand inside passages of benchmark items.

Texts are normalised byte by byte: A-Z become lower case, every byte that is no
letter, digit or part of a non-ASCII character becomes a space, runs of spaces
become one. The windows of the items, with a space on either side, form one
Aho-Corasick automaton, which reads each normalised text once. Hits are carried
back as word numbers, and to the original text by the offsets of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Sent, materialize, prepare, string_type

WINDOW_WORDS = 13
#: A document is contaminated when hits are at least one word in so many.
SHARE = 20
#: Bytes of window text in one automaton. Larger benchmarks take several passes, each whole.
AUTOMATON_BYTES = 8_000_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(text: str | None, n: int = WINDOW_WORDS) -> set[bytes]:
    """Windows of an item: n consecutive words, or all of them if it has fewer."""
    w = words(text)
    return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def build_automaton(items: Iterable[tuple[str, set[bytes]]]) -> ahocorasick.Automaton:
    """Automaton over windows; a value has the words of a window and the items that contain it."""
    owners: dict[bytes, list[str]] = {}
    for item, texts in items:
        for w in texts:
            owners.setdefault(w, []).append(item)
    found = ahocorasick.Automaton()
    for w, names in owners.items():
        found.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(names)))
    if owners:
        found.make_automaton()
    return found


def scan(automaton: ahocorasick.Automaton, text: str | None) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, numbers of the words that are hit, items found."""
    w = words(text)
    none = np.empty(0, np.int64)
    if not w or not len(automaton):
        return len(w), none, set()
    plain = f" {b' '.join(w).decode('latin-1')} "
    hits = list(automaton.iter(plain))
    if not hits:
        return len(w), none, set()
    spaces = np.flatnonzero(np.frombuffer(plain.encode("latin-1"), np.uint8) == 32)
    # the space that ends an occurrence follows word number (its rank - 1)
    last = np.searchsorted(spaces, [end for end, _ in hits])
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, last - np.array([n for _, (n, _) in hits]), 1)
    np.add.at(edge, last, -1)
    return len(w), np.flatnonzero(np.cumsum(edge[:-1])), {i for _, (_, names) in hits for i in names}


def spans(text: str, numbers: np.ndarray) -> list[tuple[int, int]]:
    """Code point ranges, in the original text, of words given by number."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw)]
    point = lambda b: len(raw[:b].decode("utf-8", "surrogatepass"))
    return [(point(at[i][0]), point(at[i][1])) for i in numbers]


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int) -> Iterator[list]:
    """Items with their windows, in blocks of a bounded size. The driver holds one block."""
    block: list[tuple[str, set[bytes]]] = []
    size = 0
    for row in benchmark.select(*string_type(benchmark, [item, text])).distinct().toLocalIterator():
        if found := windows(row[text], window):
            block.append((row[item] if row[item] is not None else "", found))
            size += sum(map(len, found))
            if size >= limit:
                yield block
                block, size = [], 0
    yield block


N_WORDS, HITS, ITEMS = "_scan_words", "_scan_hits", "_scan_items"
_FOUND = T.StructType([
    T.StructField(N_WORDS, T.LongType()),
    T.StructField(HITS, T.ArrayType(T.IntegerType())),
    T.StructField(ITEMS, T.ArrayType(T.StringType())),
])
_ARROW = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()))


def scan_documents(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW_WORDS, automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``df`` with the number of words, the numbers of the hit words and the items found.

    Each row is read where it lies, without a shuffle. The executors are sent one
    block of the benchmark, of at most ``automaton_bytes`` of windows (plus one
    item). A larger benchmark is scanned block by block: each pass adds its hits
    to those of the rows so far, which are written to the shared folder between.
    """
    spark = prepare(df.sparkSession)
    place = df.columns.index(text)
    found = df
    for number, block in enumerate(_blocks(benchmark, item, item_text, window, automaton_bytes)):
        sent = Sent(spark, block)
        base, schema = len(df.columns), T.StructType([*df.schema.fields, *_FOUND.fields])

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=number == 0) -> Iterator[pa.RecordBatch]:
            automaton = sent.made(build_automaton)
            for batch in batches:
                n, hits, items = [], [], []
                for t in batch.column(place).to_pylist():
                    count, hit, names = scan(automaton, t)
                    n.append(count)
                    hits.append(hit.astype(np.int32))
                    items.append(sorted(names))
                if not first:
                    hits = [np.union1d(a, b) for a, b in zip(batch.column(base + 1).to_pylist(), hits)]
                    items = [sorted({*a, *b}) for a, b in zip(batch.column(base + 2).to_pylist(), items)]
                more = [pa.array(x, t) for x, t in zip((n, hits, items), _ARROW)]
                arrays = [*batch.columns[:base], *more]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

        found = (found if number == 0 else materialize(found, "scan-block")).mapInArrow(run, schema)
    return found


def _contaminated(share: int):
    hit = F.size(HITS).cast("bigint")
    return (hit > 0) & (hit * share >= F.col(N_WORDS))


def contamination(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE, **params
) -> DataFrame:
    """Hits of a benchmark in each document.

    Rows: key, n_words, n_hit, n_items, items (sorted as strings), contaminated
    (n_hit > 0 and share * n_hit >= n_words). A null or empty text has no words
    and is not contaminated; an item without words is never found; an item with
    a null name is named ''. Repeated documents stay, repeated items count once.
    Only the named columns are read. Further parameters: see ``scan_documents``.
    """
    docs = df.select(F.col(f"`{key}`"), *string_type(df, [text]))
    return scan_documents(docs, benchmark, text, **params).select(
        F.col(f"`{key}`"),
        F.col(N_WORDS).alias("n_words"),
        F.size(HITS).cast("bigint").alias("n_hit"),
        F.size(ITEMS).cast("bigint").alias("n_items"),
        F.col(ITEMS).alias("items"),
        _contaminated(share).alias("contaminated"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The item list as a SHA-256 of its names joined by commas."""
    joined = F.array_join("items", ",")
    return found.withColumn("items_sha256", F.sha2(joined.cast("binary"), 256)).drop("items")


def clean_documents(
    df: DataFrame, benchmark: DataFrame, text: str = "text", share: int = SHARE, **params
) -> DataFrame:
    """The rows of ``df`` that are not contaminated, with all their columns."""
    scanned = scan_documents(df, benchmark, text, **params)
    return scanned.where(~_contaminated(share)).drop(N_WORDS, HITS, ITEMS)
