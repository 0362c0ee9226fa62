"""Main text of HTML pages.

The leaf blocks of a page form a chain. A linear-chain conditional random field
marks each as content or not, from the tags and names of its ancestors, from its
text and place; Viterbi decoding gives the best labels of the whole page. The
field is trained on generated pages whose blocks bear their labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, map_text, prepare, string_type
from shelfwise.llm.html_blocks import Block, blocks
from shelfwise.llm.html_pages import read_signs, signed_pages

#: Generated pages that the field is fitted on, and the seed they are drawn with.
PAGES, SEED = 700, 13
BUCKETS = 1 << 14
_LENGTHS = (2, 4, 7, 12, 20, 35, 70)
_SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")
#: Words that furniture of pages often holds.
_CUES = re.compile(
    r"\b(cookies?|subscribe|newsletter|sign up|sign in|log ?in|log out|register|e-?mail|password|advertisement|sponsored|promoted|"
    r"comments?|repl(?:y|ies)|share|tweet|follow us|related|read more|more from|see also|most read|popular|trending|recent posts|"
    r"privacy|terms|rights reserved|copyright|menu|home|search|about us|contact|skip to|accept|consent|we use|by continuing|"
    r"categories|tags|archives?|previous|next|page|says|ago|likes?|submit|send|your name)\b"
)


def _number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


@lru_cache(20_000)
def path_features(path: tuple[str, ...]) -> tuple[int, ...]:
    """Feature numbers of the ancestors: tags at any depth and next to the block, words of their names."""
    tags = [p.split(" ", 1)[0] for p in path]
    found = {f"in {t}" for t in tags} | {"any", f"near {' '.join(tags[-2:])}", f"own {tags[-1] if tags else ''}"}
    for p in path:
        for word in p.split(" ")[1:]:
            found |= {f"name {word}", f"stem {word[:5]}"}
    own = path[-1].split(" ")[1:] if path else []
    found |= {f"own name {word}" for word in own}
    return tuple(sorted(map(_number, found)))


@lru_cache(200_000)
def _named(name: str) -> int:
    return _number(name)


def text_features(block: Block) -> list[int]:
    """Feature numbers of a block's own text."""
    text = block.text
    words = text.count(" ") + 1
    share = block.linked / len(text)
    size = sum(words > x for x in _LENGTHS)
    links = 0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3
    ends = _SENTENCE.search(text[-2:]) is not None
    found = [f"words {size}", f"links {links}", f"words {size} links {links}", f"ends {ends} {size > 2}"]
    if "©" in text or "&copy" in text:
        found.append("copyright")
    if "|" in text or "»" in text or "·" in text or "›" in text:
        found.append(f"bar {size > 3}")
    if text[:1].isdigit():
        found.append("digit")
    if text[-1] == ":":
        found.append("colon")
    if size < 6:
        found += [f"cue {c}" for c in {*_CUES.findall(text.lower())}]
    return [_named(f) for f in found]


def page_features(found: Sequence[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all blocks one after another, and where each block's begin."""
    flat: list[int] = []
    starts = []
    heading = False
    for i, block in enumerate(found):
        starts.append(len(flat))
        flat += path_features(block.path)
        flat += text_features(block)
        flat.append(_named(f"first {min(i, 2)}"))
        flat.append(_named(f"last {min(len(found) - 1 - i, 2)}"))
        flat.append(_named(f"headed {heading}"))
        heading = heading or any(p.startswith("h1") for p in block.path[-2:])
    return np.array(flat, np.int64), np.array(starts, np.int64)


class BlockField:
    """Linear-chain field over two labels: 0 other, 1 content."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((BUCKETS, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def scores(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[flat], starts, axis=0)

    def decode(self, flat: np.ndarray, starts: np.ndarray) -> list[int]:
        """Viterbi labels of a page's blocks; of equal ways the one with content last."""
        scores = self.scores(flat, starts).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            stay, leave = a + m00 > b + m10, a + m01 > b + m11
            a, b = (a + m00 if stay else b + m10) + x, (a + m01 if leave else b + m11) + y
            back.append((stay, leave))
        labels = [int(b >= a)]
        for step in reversed(back):
            labels.append(0 if step[labels[-1]] else 1)
        return labels[::-1]

    def fit(
        self, pages: Sequence[tuple[np.ndarray, np.ndarray]], gold: Sequence[Sequence[int]], steps: int = 90, rate: float = 0.4,
        penalty: float = 3e-5,
    ) -> None:
        """Maximum likelihood with an L2 penalty by AdaGrad, all chains at once."""
        sizes = [len(s) for _, s in pages]
        n, length, total = len(pages), max(sizes), sum(sizes)
        flat = np.concatenate([f for f, _ in pages])
        starts = np.concatenate([s + at for (_, s), at in zip(pages, np.cumsum([0] + [len(f) for f, _ in pages[:-1]]))])
        owner = np.repeat(np.arange(total), np.diff(np.append(starts, len(flat))))
        row, place = np.repeat(np.arange(n), sizes), np.concatenate([np.arange(s) for s in sizes])
        mask = np.zeros((n, length), bool)
        mask[row, place] = True
        labels = np.concatenate([np.asarray(g) for g in gold])
        truth = np.eye(2)[labels]
        grid = np.zeros((n, length), np.int64)
        grid[row, place] = labels
        inner = mask[:, 1:]
        true_moves = np.zeros((2, 2))
        np.add.at(true_moves, (grid[:, :-1][inner], grid[:, 1:][inner]), 1)
        speed, speed_moves = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        for _ in range(steps):
            scores = np.zeros((n, length, 2))
            scores[row, place] = np.add.reduceat(self.weights[flat], starts, axis=0)
            ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            ahead[:, 0] = scores[:, 0]
            for t in range(1, length):
                into = ahead[:, t - 1, :, None] + self.moves
                into = np.logaddexp(into[:, 0], into[:, 1]) + scores[:, t]
                ahead[:, t] = np.where(mask[:, t, None], into, ahead[:, t - 1])
            for t in range(length - 2, -1, -1):
                out = self.moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]
                behind[:, t] = np.where(mask[:, t + 1, None], np.logaddexp(out[:, :, 0], out[:, :, 1]), 0)
            norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
            share = np.exp(ahead + behind - norm[:, None, None])[row, place]
            pairs = ahead[:, :-1, :, None] + self.moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :]
            pairs = np.exp(pairs - norm[:, None, None, None]) * inner[:, :, None, None]
            error = (truth - share)[owner]
            slope = np.stack([np.bincount(flat, error[:, k], BUCKETS) for k in range(2)], 1) / total - penalty * self.weights
            slope_moves = (true_moves - pairs.sum((0, 1))) / total - penalty * self.moves
            speed, speed_moves = speed + slope**2, speed_moves + slope_moves**2
            self.weights += rate * slope / np.sqrt(speed)
            self.moves += rate * slope_moves / np.sqrt(speed_moves)


def train(pages: int = PAGES, seed: int = SEED) -> BlockField:
    """A field fitted on generated pages."""
    found, gold = [], []
    for page in signed_pages(pages, seed):
        met, labels = read_signs(page)
        found.append(page_features(met))
        gold.append(labels)
    field = BlockField()
    field.fit(found, gold)
    return field


def main_text(page: str | None, field: BlockField) -> str:
    """The content blocks of a page, one to a line."""
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, y in zip(found, field.decode(*page_features(found))) if y)


def extract(
    df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", pages: int = PAGES, seed: int = SEED
) -> DataFrame:
    """Rows (key, url, text, n_chars), one for each row of ``df``.

    A null or empty page, or one without content, has the empty text. Repeated and
    null keys stay. Other columns are ignored. The pages are read where they lie,
    without a shuffle; the fit is on ``pages`` generated pages whatever the input.
    """
    spark = prepare(df.sparkSession)
    field = train(pages, seed)
    used = np.flatnonzero(np.abs(field.weights).max(1) > 0)
    sent = Sent(spark, (used, field.weights[used], field.moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        places, weights, moves = sent.broadcast.value
        whole = np.zeros((BUCKETS, 2))
        whole[places] = weights
        model = BlockField(whole, moves)
        for batch in batches:
            texts = [main_text(h, model) for h in batch.column(2).to_pylist()]
            yield [batch.column(0), batch.column(1), texts, list(map(len, texts))]

    rows = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [url, page]))
    found = map_text(rows, run, "id string, url string, text string, n_chars bigint")
    return found.select(F.col("id").cast(df.schema[key].dataType).alias(key), F.col("url").alias(url), "text", "n_chars")
