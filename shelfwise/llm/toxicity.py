"""Toxicity scores of deobfuscated texts.

A character language model is counted over the words of all documents. In each
text the places that may be disguised are found (every token that mixes letters with
signs, characters that stand alone, letters three times or more) and restored by the
noisy-channel decoder; it decides whether a sign is a letter. Tokens without any
letter are not read.
The restored words and their first letters are the features of a logistic
regression, fitted on a bounded sample of the labelled rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, labelled_sample, map_text, materialize, prepare, string_type
from shelfwise.llm.deobfuscation import LETTERS, CharModel, is_read, restore, word_grams
from shelfwise.llm.shingles import mix

#: Labelled rows the classifier is fitted on, at most, and features it keeps.
SAMPLE_ROWS = 12_000
FEATURES = 1_500
#: A feature must stand in so many toxic rows of the sample, and stand out by so many deviations.
MIN_ROWS, MIN_DEVIATIONS = 4, 3.0
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
BUCKET_BITS = 24
#: Characters restored as one piece, at most; longer places go in pieces that overlap by half.
PIECE = 40
#: Restored places that a worker keeps.
KEPT_PLACES = 200_000

_TOKEN = re.compile(r"\S+")
#: One character that stands alone, signs around it allowed.
_SINGLE = re.compile(r"[^\w\s]*\w[^\w\s]*|[^\w\s]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
#: Kinds of tokens: bit 0 is set for disguised ones, bit 1 for single characters.
_DISGUISED, _SPACED = re.compile(rb"[\1\3]"), re.compile(rb"[\2\3]{3,}")
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_random = np.random.default_rng(11)
_BYTES = _random.integers(1, 2**63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _core(token: str) -> str:
    """The token without the characters at its ends that the decoder can only drop."""
    a, b = 0, len(token)
    while a < b and not is_read(token[a]):
        a += 1
    while b > a and not is_read(token[b - 1]):
        b -= 1
    return token[a:b]


def is_disguised(token: str) -> bool:
    """Whether a token mixes letters with any sign, or has a letter three times or more in a row.

    Signs at the ends that can only be dropped do not count, nor do combining marks.
    """
    core = token if token.isalpha() else _core(token)
    if core.isalpha():
        return _STRETCHED.search(core) is not None
    signs = any(not c.isalpha() and unicodedata.category(c)[0] != "M" for c in core)
    return any(c.isalpha() for c in core) and (signs or _STRETCHED.search(core) is not None)


def _places(tokens: list[str], seen: dict[str, int]) -> list[tuple[int, int, bool]]:
    """Places as numbers of tokens, as ``disguised`` has them in bytes; ``seen`` keeps the kinds of tokens."""
    if len(seen) > 200_000:
        seen.clear()
    for token in set(tokens).difference(seen):
        seen[token] = is_disguised(token) + 2 * bool(_SINGLE.fullmatch(token))
    kinds = bytes(map(seen.__getitem__, tokens))
    found = [(*m.span(), False) for m in _DISGUISED.finditer(kinds)]
    return found + [(*m.span(), True) for m in _SPACED.finditer(kinds)]


def disguised(raw: bytes) -> list[tuple[int, int, bool]]:
    """Places of a lower-case text in UTF-8 that need restoring: start, end, whether they are spaced letters."""
    text = raw.decode("utf-8", "surrogatepass")
    at = lambda i: len(text[:i].encode("utf-8", "surrogatepass"))
    spans = [m.span() for m in _TOKEN.finditer(text)]
    return [(at(spans[a][0]), at(spans[b - 1][1]), spaced) for a, b, spaced in _places(text.split(), {})]


def restore_text(text: str, model: CharModel, known: dict, seen: dict[str, int] | None = None) -> str:
    """The restored words of the disguised places of a lower-case text, joined by blanks."""
    out = {}
    tokens = text.split()
    places = [(" ".join(tokens[a:b]), spaced) for a, b, spaced in _places(tokens, {} if seen is None else seen)]
    for place, spaced in dict.fromkeys(places):
        place = _core(place)
        step = PIECE if len(place) <= PIECE else PIECE // 2
        for i in range(0, max(len(place) - (PIECE - step), 1), step):
            piece = place[i : i + PIECE]
            if not any(c.isalpha() for c in piece):
                continue
            if (piece, spaced) not in known:
                if len(known) >= KEPT_PLACES:
                    known.clear()
                known[piece, spaced] = restore(piece, model, spaced)
            out[known[piece, spaced]] = None
    return " ".join(out)


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the words of lower-case texts: whole words, and their first bytes."""
    raws = [t.encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts]
    numbers, buckets = [], []
    for number, raw in enumerate(raws):
        bytes_ = np.frombuffer(raw, np.uint8)
        edges = np.diff((bytes_ != 32).view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if not len(starts):
            continue
        value = np.zeros(len(starts), np.uint64)
        length = ends - starts
        padded = np.concatenate([bytes_, np.zeros(max(PREFIXES) + 1, np.uint8)])
        found = []
        for k in range(max(PREFIXES)):
            more = length > k
            value = np.where(more, mix(value * np.uint64(_BASE) + _BYTES[padded[starts + k]]), value)
            if k + 1 in PREFIXES:
                found.append(value[length > k + 1] + np.uint64(k + 1))
        # words of up to eight bytes as a whole; longer ones by their first eight and the length
        found.append(value + np.uint64(1000) + np.minimum(length, 60).astype(np.uint64))
        unique = np.unique(mix(np.concatenate(found)) >> np.uint64(64 - BUCKET_BITS))
        numbers.append(np.full(len(unique), number))
        buckets.append(unique.astype(np.int64))
    if not numbers:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(numbers), np.concatenate(buckets)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for t in batch.column(0).to_pylist():
            if t:
                counts.update(t.lower().encode("utf-8", "surrogatepass").translate(_FOLD).decode("utf-8", "replace").split())
        if len(counts) > 200_000:
            yield [list(counts), list(counts.values())]
            counts.clear()
    yield [list(counts), list(counts.values())]


def char_model(df: DataFrame, text: str = "text") -> CharModel:
    """The character model of all words of all documents.

    Words are counted over the whole table first (partial counts in the tasks);
    the model's grams are then counted over the distinct words. Their number is
    bounded by the symbols: (LETTERS + 2) ** ORDER.
    """
    words = map_text(df.select(*string_type(df, [text])), _count_words, "word string, n bigint")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "words")

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for c in w:
                    counts[c] += n
        yield [list(counts), list(counts.values())]

    found = map_text(words, letters, "letter string, n bigint").groupBy("letter").agg(F.sum("n").alias("n"))
    counted = [r["letter"] for r in found.orderBy(F.desc("n"), "letter").collect() if r["letter"].isalpha()]
    # the most frequent letters of any script; a small corpus is filled up with basic ones
    chosen = list(dict.fromkeys([*counted, *"abcdefghijklmnopqrstuvwxyz"]))[:LETTERS]
    known = frozenset(chosen)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for g in word_grams(w, known):
                    counts[g] += n
        yield [list(counts), list(counts.values())]

    rows = map_text(words, grams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return CharModel("".join(chosen), [r["gram"] for r in rows], [r["n"] for r in rows])


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the key as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(sent: Sent):
    """Features of the texts of a batch, with the words restored in them; a worker keeps what it restored."""

    def of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        model, known, seen = sent.made(_with_memory)
        lower = [(t or "").lower() for t in texts]
        return word_features([f"{t} {restore_text(t, model, known, seen)}" if t else "" for t in lower])

    return of


def _with_memory(model: CharModel) -> tuple[CharModel, dict, dict]:
    return model, {}, {}


def fit(df: DataFrame, labels: DataFrame, model: Sent, key: str, text: str, label: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Chosen features, their weights and the bias, from labelled rows that are not held out."""
    spark = df.sparkSession
    known = labels.where(~held_out(key)).select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"))
    chosen = labelled_sample(df, known, key, text, SAMPLE_ROWS)
    features = _features(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            number, bucket = features(batch.column(1).to_pylist())
            cuts = np.searchsorted(number, np.arange(batch.num_rows + 1))
            yield [batch.column(0), [bucket[a:b] for a, b in zip(cuts[:-1], cuts[1:])]]

    stored = materialize(map_text(chosen, rows, "label int, features array<bigint>"), "toxic-sample")
    sizes = {r["label"]: r["n"] for r in stored.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return np.empty(0, np.int64), np.empty(0), float(np.log((n1 + 0.1) / (n0 + 1.0)))
    a, b = F.col("toxic"), F.col("n") - F.col("toxic")
    score = (F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))) / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    best = (
        stored.select("label", F.explode("features").alias("f"))
        .groupBy("f")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .where(F.col("toxic") >= MIN_ROWS)
        .withColumn("score", score)
        .where(F.col("score") >= MIN_DEVIATIONS)
        .orderBy(F.desc("score"), "f")
        .limit(FEATURES)
    )
    keep = np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64))
    wanted = F.broadcast(spark.createDataFrame([(keep.tolist(),)], "keep array<bigint>"))
    data = stored.crossJoin(wanted).select("label", F.array_intersect("features", "keep").alias("f")).collect()
    x = np.zeros((len(data), len(keep)), np.float32)
    for i, r in enumerate(data):
        x[i, np.searchsorted(keep, r["f"])] = 1
    y = np.array([r["label"] for r in data], np.float32)
    order = np.lexsort((x.sum(1), y))
    weights, bias = logistic(x[order], y[order])
    return keep, weights, bias


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 2.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with non-negative weights and an L2 penalty, by accelerated gradient steps."""
    w = v = np.zeros(x.shape[1], np.float32)
    bias = vb = float(np.log(max(y.mean(), 1e-3) / max(1 - y.mean(), 1e-3)))
    rate = 4.0 / max(float((x.sum(1) ** 2).mean()) + 1, 1.0) / len(y) * 4
    for step in range(steps):
        p = 1 / (1 + np.exp(-(x @ v + vb)))
        g, gb = x.T @ (p - y) + penalty * v, float((p - y).sum())
        w_next, bias_next = np.maximum(v - rate * g, 0), vb - rate * gb
        pull = step / (step + 3)
        v, vb = w_next + pull * (w_next - w), bias_next + pull * (bias_next - bias)
        w, bias = w_next, bias_next
    return w.astype(np.float64), float(bias)


def score_documents(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``df`` with ``score`` and ``predicted`` after its own columns.

    Labels of rows that are held out are not read. A null or empty text has the
    score of a text without any feature. Repeated rows get equal scores. Without
    labels of both kinds every score is the share of toxic labels.
    """
    spark = prepare(df.sparkSession)
    model = Sent(spark, char_model(df, text))
    keep, weights, bias = fit(df, labels, model, key, text, label)
    features = _features(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, bucket = features(batch.column(place).cast(pa.string()).to_pylist())
            total = np.full(batch.num_rows, bias)
            if len(keep):
                at = np.minimum(np.searchsorted(keep, bucket), len(keep) - 1)
                hit = keep[at] == bucket
                np.add.at(total, number[hit], weights[at[hit]])
            score = 1 / (1 + np.exp(-total))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=names
            )

    place = df.columns.index(text)
    schema = df.select("*", F.lit(0.0).alias(SCORE), F.lit(0).alias(PREDICTED)).schema
    names = schema.names
    return df.mapInArrow(run, schema)


SCORE, PREDICTED = "_toxic_score", "_toxic_predicted"


def toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Rows (key, held_out, score, predicted), one for each row of ``df``."""
    scored = score_documents(df.select(key, text), labels, key, text, **params)
    return scored.select(
        F.col(f"`{key}`"),
        held_out(key).alias("held_out"),
        F.col(SCORE).alias("score"),
        F.col(PREDICTED).alias("predicted"),
    )


def without_toxic(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns."""
    scored = score_documents(df, labels, key, text, **params)
    return scored.where(F.col(PREDICTED) == 0).drop(SCORE, PREDICTED)
