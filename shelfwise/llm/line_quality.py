"""Quality of documents by labelling their lines.

Counts over words and lines give the base rules. A linear-chain conditional
random field marks each line as content or boilerplate from its shape and that of
its neighbours; the share of content decides whether a document is kept. The
field is fitted on a bounded sample of documents with a quality label, each line
bearing the label of its document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, labelled_sample, map_text, materialize, prepare, string_type

#: Labelled documents that the field is fitted on, at most, and lines of one training chain.
SAMPLE_ROWS, CHAIN_LINES = 2_000, 40
MIN_WORDS = 50
#: A document fails when more than this share, in percent, of its words is in repeated windows.
MAX_REPEATED = 50
#: Share of the characters that must stand in content lines.
CONTENT_SHARE = 0.5

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
_UPPER, _DIGITS, _SIGNS = (bytes(map(ord, s)) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", SYMBOLS))
_STEPS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
_LENGTHS = (0, 1, 3, 6, 12, 25, 60, 150)
SHARES = 6
FEATURES = SHARES * (len(_STEPS) + 1) + len(_LENGTHS) + 6


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            duplicates += line in seen
            seen.add(line)
    return len(words), chars, sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    start = (times[which] > 1).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    edge[:-3] += start
    edge[3:] -= start
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each line (SHARES + 4 of them), and its characters that are no blanks."""
    rows, sizes = [], []
    seen: set[bytes] = set()
    steps, lengths = len(_STEPS) + 1, SHARES * (len(_STEPS) + 1)
    for raw in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = raw.split()
        n = max(1, sum(map(len, words)))
        count = max(1, len(words))
        shares = (
            (len(raw) - len(raw.translate(None, _SIGNS))) / n,
            (len(raw) - len(raw.translate(None, _UPPER))) / n,
            (len(raw) - len(raw.translate(None, _DIGITS))) / n,
            raw.count(b"|") / count,
            raw.count(b"!!") / count,
            1 - len(set(words)) / count,
        )
        row = [k * steps + sum(s > x for x in _STEPS) for k, s in enumerate(shares)]
        row.append(lengths + sum(len(words) > x for x in _LENGTHS) - (len(words) > 0))
        rest = lengths + len(_LENGTHS)
        row.append(rest + (raw in seen and bool(words)))
        row.append(rest + 2 + (raw.rstrip()[-1:] in (b".", b"!", b"?", b":")))
        row.append(rest + 4 + (raw.lstrip()[:1].isupper()))
        seen.add(raw)
        rows.append(row)
        sizes.append(sum(map(len, words)))
    return np.array(rows), np.array(sizes)


class LineField:
    """Linear-chain field over two labels: 0 boilerplate, 1 content."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((FEATURES, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def decode(self, rows: np.ndarray) -> np.ndarray:
        """Viterbi labels of the lines of a text; a tie is content."""
        scores = self.weights[rows].sum(1).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            stay, leave = a + m00 > b + m10, a + m01 > b + m11
            a, b = (a + m00 if stay else b + m10) + x, (a + m01 if leave else b + m11) + y
            back.append((stay, leave))
        label = int(b >= a)
        labels = [label]
        for step in reversed(back):
            label = 0 if step[label] else 1
            labels.append(label)
        return np.array(labels[::-1])

    def fit(self, chains: list[np.ndarray], labels: list[int], steps: int = 80, rate: float = 0.5) -> None:
        """Maximum likelihood with an L2 penalty; all chains at once, padded to one length."""
        if not chains or len(set(labels)) < 2:
            return
        n, length = len(chains), max(map(len, chains))
        rows = np.zeros((n, length, chains[0].shape[1]), np.int64)
        mask = np.zeros((n, length), bool)
        for i, c in enumerate(chains):
            rows[i, : len(c)], mask[i, : len(c)] = c, True
        gold = np.zeros((n, length, 2))
        gold[np.arange(n), :, labels] = 1
        gold *= mask[:, :, None]
        both = (mask[:, 1:] & mask[:, :-1]).sum(1)
        gold_moves = np.zeros((2, 2))
        np.add.at(gold_moves, (labels, labels), both)
        size = mask.sum()
        speed, speed_moves = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        for _ in range(steps):
            scores = self.weights[rows].sum(2) * mask[:, :, None]
            ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            ahead[:, 0] = scores[:, 0]
            for t in range(1, length):
                into = ahead[:, t - 1, :, None] + self.moves
                into = np.logaddexp(into[:, 0], into[:, 1]) + scores[:, t]
                ahead[:, t] = np.where(mask[:, t, None], into, ahead[:, t - 1])
            for t in range(length - 2, -1, -1):
                out = self.moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]
                out = np.logaddexp(out[:, :, 0], out[:, :, 1])
                behind[:, t] = np.where(mask[:, t + 1, None], out, 0)
            norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
            share = np.exp(ahead + behind - norm[:, None, None]) * mask[:, :, None]
            pairs = ahead[:, :-1, :, None] + self.moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :]
            pairs = np.exp(pairs - norm[:, None, None, None]) * mask[:, 1:, None, None]
            slope = np.zeros_like(self.weights)
            np.add.at(slope, rows.reshape(-1, rows.shape[2]), (gold - share).reshape(-1, 1, 2))
            slope = slope / size - 1e-4 * self.weights
            slope_moves = (gold_moves - pairs.sum((0, 1))) / size - 1e-4 * self.moves
            speed, speed_moves = speed + slope**2, speed_moves + slope_moves**2
            self.weights += rate * slope / np.sqrt(speed)
            self.moves += rate * slope_moves / np.sqrt(speed_moves)


def fit_field(df: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> LineField:
    """The field fitted on labelled documents: those first in the order of a hash of the key."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"))
    chosen = labelled_sample(df, known, key, text, SAMPLE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            label_of, found = [], []
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = line_features(t or "")[0]
                for i in range(0, len(rows), CHAIN_LINES):
                    label_of.append(y)
                    found.append(rows[i : i + CHAIN_LINES].ravel())
            yield [label_of, found]

    stored = materialize(map_text(chosen, run, "label int, features array<bigint>"), "quality-sample")
    # documents of very many lines give several chains; as many as documents are used
    data = stored.orderBy(F.xxhash64("features"), "label").limit(SAMPLE_ROWS).collect()
    field = LineField()
    width = SHARES + 4
    field.fit([np.array(r["features"]).reshape(-1, width) for r in data], [r["label"] for r in data])
    return field


def content_share(text: str | None, field: LineField) -> float:
    """Share of the characters of a text that stand in content lines; 0 without words."""
    if not text:
        return 0.0
    rows, sizes = line_features(text)
    total = sizes.sum()
    return float(sizes[field.decode(rows) == 1].sum() / total) if total else 0.0


def quality(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    least: float = CONTENT_SHARE,
) -> DataFrame:
    """Rows (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share).

    One row for each row of ``df``; a null or empty text has no words and fails.
    Without labels of both kinds every line is content. The texts are read where
    they lie, without a shuffle.
    """
    spark = prepare(df.sparkSession)
    field = fit_field(df, labels, key, text, label)
    sent = Sent(spark, (field.weights, field.moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        model = LineField(*sent.broadcast.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = list(zip(*map(base_counts, texts)))
            yield [batch.column(0), *map(list, counts), [content_share(t, model) for t in texts]]

    docs = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [text]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = map_text(docs, run, "id string, " + ", ".join(f"{n} bigint" for n in names) + ", content_share double")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return found.select(
        F.col("id").cast(df.schema[key].dataType).alias(key),
        *names,
        failed.alias("base_failed"),
        (~failed & (F.col("content_share") >= least)).alias("kept"),
        "content_share",
    )
