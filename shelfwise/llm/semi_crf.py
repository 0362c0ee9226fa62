"""Semi-Markov conditional random field over the tokens of a text region.

A labelling cuts the tokens into segments: single tokens outside, and entities of
bounded length. The score of an entity comes from features of its whole span, so
a checksum or a count over all its digits is one feature. Forward and backward
sums give the gradient for training; Viterbi search gives boundaries and types
together.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tokens and characters of an entity, at most.
MAX_TOKENS, MAX_CHARS = 26, 72
BUCKETS = 1 << 13

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|.", re.DOTALL)
_INSIDE = frozenset("+().-_%@[] ")
_AT = re.compile(r" ?[\[(] ?at ?[\])] ?| at | ?@ ?", re.I)
_DOT = re.compile(r" ?[\[(] ?(?:dot|\.) ?[\])] ?| dot ", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CUES = ("tel", "phone", "call", "fax", "mobile", "card", "visa", "ip", "host", "server", "mail", "email", "contact",
         "version", "date", "isbn", "order", "no")


class Segment(NamedTuple):
    """An entity candidate: token borders and feature numbers."""

    start: int
    end: int
    features: np.ndarray


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "word" if c.isalnum() else "blank" if c.isspace() else c if c in "+@.-_/%=\"" else "sign"


@lru_cache(50_000)
def _features(raw: str, left: str, beyond: str, before: str) -> np.ndarray:
    """Feature numbers of a span: itself, the sides, two characters after it, the text before it."""
    plain = plain_address(raw)
    digits = "".join(c for c in raw if c in "0123456789")
    groups = re.findall("[0-9]+", raw)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", "9", plain))
    found = ["any", f"shape {shape[:20]}", f"digits {min(len(digits), 24)}", f"groups {'-'.join(str(len(g)) for g in groups[:7])}",
             f"left {_side(left, 0)}", f"right {_side(beyond, 0)}", f"signs {''.join(sorted(set(plain) & _INSIDE))}"]
    if len(groups) == 4 and shape == "9.9.9.9":
        found.append(f"octets {max(map(len, groups)) < 4 and all(int(g) < 256 for g in groups)}")
        found.append(f"more {beyond[:1] == '.' and beyond[1:].isdigit() or left == '.'}")
    if 13 <= len(digits) <= 19 and "@" not in plain:
        found += [f"luhn {luhn(digits)}", f"luhn {luhn(digits)} {len(digits)} {'.' in raw}"]
    if "@" in plain:
        found += [f"email {bool(_EMAIL.fullmatch(plain))}", f"written {plain == raw}", f"at {plain.count('@')}"]
        found.append(f"tail {min(len(plain.rpartition('.')[2]), 8)} {plain.rpartition('.')[2].isalpha()}")
    if raw[0] in "+(":
        found.append(f"opens {raw[0]} {len(digits)}")
    found += [f"cue {w}" for w in before.split() if w in _CUES]
    return np.array([zlib.crc32(n.encode("utf-8", "replace")) % BUCKETS for n in found])


def plain_address(raw: str) -> str:
    """A span with written-out at and dot replaced by their signs."""
    return _DOT.sub(".", _AT.sub("@", raw)) if "@" in raw or "at" in raw.lower() or "[.]" in raw else raw


def span_features(text: str, start: int, end: int) -> np.ndarray:
    """Feature numbers of a span of a text."""
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 24) : start])[-2:]
    cues = " ".join(w for w in map(str.lower, before) if w in _CUES)
    return _features(text[start:end], text[start - 1 : start] if start else "", text[end : end + 2], cues)


def candidates(text: str, tokens: Sequence[tuple[int, int]]) -> list[Segment]:
    """Spans that may be entities: from word, digits, + or ( to word or digits."""
    words = [text[a:b] for a, b in tokens]
    digit = [w.isdigit() and w.isascii() for w in words]
    found = []
    for i, first in enumerate(words):
        if not (digit[i] or first[0].isalpha() or first in "+("):
            continue
        n_digits, letters, link, blanks = 0, False, False, 0
        for j in range(i, min(len(words), i + MAX_TOKENS)):
            w = words[j]
            if tokens[j][1] - tokens[i][0] > MAX_CHARS:
                break
            if digit[j]:
                n_digits += len(w)
            elif w[0].isalpha():
                if w.lower() == "at" and j > i and not words[j - 1][0].isalnum():
                    link = True
                letters = True
            elif w not in _INSIDE:
                break
            else:
                link = link or w == "@"
            blanks = blanks + 1 if w == " " else 0
            if blanks > 1 or (letters and not link and w == " " and not _link_follows(words, j)):
                break
            if (link if letters else n_digits >= 4) and (digit[j] or w[0].isalpha()):
                plain = plain_address(text[tokens[i][0] : tokens[j][1]]) if letters else ""
                if not letters or (" " not in plain and plain.count("@") == 1):
                    found.append(Segment(i, j + 1, span_features(text, tokens[i][0], tokens[j][1])))
    return found


def _link_follows(words: Sequence[str], j: int) -> bool:
    """Whether ``at``, maybe in brackets, or @ follows the blank at j."""
    return any(w.lower() in ("at", "@") for w in words[j + 1 : j + 3])


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Borders of words, digit groups and single signs."""
    return [m.span() for m in TOKEN.finditer(text)]


class SemiCrf:
    """Weights of span features by kind, and of an entity or no entity after either."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((BUCKETS, len(KINDS))) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def _scores(self, segments: Sequence[Segment]) -> np.ndarray:
        if not segments:
            return np.zeros((0, len(KINDS)))
        cuts = np.concatenate([[0], np.cumsum([len(s.features) for s in segments])[:-1]])
        return np.add.reduceat(self.weights[np.concatenate([s.features for s in segments])], cuts, axis=0)

    def decode(self, text: str) -> list[tuple[str, int, int]]:
        """The best entities of a region, as kind, start, end."""
        tokens = tokens_of(text)
        segments = candidates(text, tokens)
        if not segments:
            return []
        scores = self._scores(segments)
        kinds, best_scores = scores.argmax(1), scores.max(1)
        by_end: dict[int, list[int]] = {}
        for k, s in enumerate(segments):
            by_end.setdefault(s.end, []).append(k)
        best = np.full((len(tokens) + 1, 2), -np.inf)
        best[0, 0] = 0
        back: list[list] = [[None, None] for _ in range(len(tokens) + 1)]
        for i in range(1, len(tokens) + 1):
            stay = best[i - 1] + self.moves[:, 0]
            best[i, 0], back[i][0] = stay.max(), (i - 1, int(stay.argmax()), None)
            for k in by_end.get(i, ()):
                into = best[segments[k].start] + self.moves[:, 1]
                total = into.max() + best_scores[k]
                if total > best[i, 1]:
                    best[i, 1], back[i][1] = total, (segments[k].start, int(into.argmax()), k)
        found, i, state = [], len(tokens), int(best[-1].argmax())
        while i:
            before, state_before, k = back[i][state]
            if k is not None:
                found.append((KINDS[kinds[k]], tokens[before][0], tokens[i - 1][1]))
            i, state = before, state_before
        return found[::-1]

    def gradient(self, n: int, segments: Sequence[Segment], gold: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
        """Observed less expected: for each segment and kind, and for the moves."""
        scores = self._scores(segments)
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for k, s in enumerate(segments):
            by_end.setdefault(s.end, []).append(k)
            by_start.setdefault(s.start, []).append(k)
        total = np.logaddexp.reduce(scores, axis=1) if len(segments) else np.empty(0)
        ahead, behind = np.full((n + 1, 2), -np.inf), np.full((n + 1, 2), -np.inf)
        ahead[0, 0] = 0
        for i in range(1, n + 1):
            ahead[i, 0] = np.logaddexp.reduce(ahead[i - 1] + self.moves[:, 0])
            if i in by_end:
                ahead[i, 1] = np.logaddexp.reduce(
                    [np.logaddexp.reduce(ahead[segments[k].start] + self.moves[:, 1]) + total[k] for k in by_end[i]]
                )
        behind[n] = 0
        for i in range(n - 1, -1, -1):
            ways = [self.moves[:, 0] + behind[i + 1, 0]]
            ways += [self.moves[:, 1] + total[k] + behind[segments[k].end, 1] for k in by_start.get(i, ())]
            behind[i] = np.logaddexp.reduce(ways, axis=0)
        norm = np.logaddexp.reduce(ahead[n])
        spans, moves = np.zeros_like(scores), np.zeros((2, 2))
        inside, at = np.zeros(n, bool), 0
        for (start, end), _ in gold.items():
            inside[start:end] = True
        state = 0
        while at < n:
            end = next((e for s, e in gold if s == at), None)
            moves[state, int(end is not None)] += 1
            state, at = (1, end) if end is not None else (0, at + 1)
        for i in range(1, n + 1):
            moves[:, 0] -= np.exp(ahead[i - 1] + self.moves[:, 0] + behind[i, 0] - norm)
        for k, s in enumerate(segments):
            into = ahead[s.start] + self.moves[:, 1] + behind[s.end, 1] - norm
            moves[:, 1] -= np.exp(into + total[k])
            spans[k] -= np.exp(np.logaddexp.reduce(into) + scores[k])
            if (s.start, s.end) in gold:
                spans[k, gold[s.start, s.end]] += 1
        return spans, moves

    def fit(self, examples: Sequence[tuple[str, list[tuple[str, int, int]]]], epochs: int = 6, rate: float = 0.4) -> None:
        """Maximum likelihood by AdaGrad over labelled regions (text, entities)."""
        ready = []
        for text, entities in examples:
            tokens = tokens_of(text)
            first, last = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
            segments = candidates(text, tokens)
            spans = {(s.start, s.end) for s in segments}
            gold = {(first[a], last[b]): KINDS.index(kind) for kind, a, b in entities if a in first and b in last}
            ready.append((len(tokens), segments, {k: v for k, v in gold.items() if k in spans}))
        seen, seen_moves = np.full_like(self.weights, 1e-6), np.full_like(self.moves, 1e-6)
        for _ in range(epochs):
            for n, segments, gold in ready:
                spans, moves = self.gradient(n, segments, gold)
                step = np.zeros_like(moves) + moves
                seen_moves += step**2
                self.moves += rate / 4 * step / np.sqrt(seen_moves)
                busy = np.flatnonzero(np.abs(spans).max(1) > 1e-4) if len(segments) else ()
                for k in busy:
                    for f in np.unique(segments[k].features):
                        seen[f] += spans[k] ** 2
                        self.weights[f] += rate * spans[k] / np.sqrt(seen[f])
