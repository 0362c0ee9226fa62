"""Disguised words restored by a noisy-channel decoder.

The sender's letters pass a channel that writes look-alike signs for letters,
puts separators between letters, stretches letters and masks them. What may have
been sent is a lattice over the observed characters; Viterbi search over all
states of the model finds the path that a character language model and the channel
make most likely. Masks stand for any of the LETTERS letters that the model knows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np

#: Letters that a sign is written for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
MASKS = "*#%?"
#: Look-alikes that may also be punctuation at the ends of a text.
PUNCTUATION = "!|+("
#: States that are searched one by one; more are searched as one array.
MANY = 1_000
#: Costs of the channel, in nats.
SIGN_COST, DROP_COST, STRETCH_COST, MASK_COST, BREAK_COST = 0.7, 0.3, 0.2, 2.0, 1.0
ORDER = 4
#: Symbols of the language model: the border of a word, all other letters, and these many letters.
LETTERS = 40
BORDER, OTHER = 0, 1


class CharModel:
    """Character model of ORDER symbols, interpolated by the Witten-Bell rule."""

    def __init__(self, letters: str, grams: Sequence[str], counts: Sequence[int]):
        """``grams`` are ORDER letters long, borders written as blanks, unknown letters as '?'."""
        self.index = {c: i + 2 for i, c in enumerate(letters[:LETTERS])}
        self.letters = letters[:LETTERS]
        size = len(self.index) + 2
        self.size = size
        code = {" ": BORDER, "?": OTHER} | self.index
        table = np.zeros((size,) * ORDER, np.float64)
        if len(grams):
            at = np.array([[code[c] for c in g] for g in grams])
            np.add.at(table, tuple(at.T), np.asarray(counts, np.float64))
        prob = np.full(size, 1.0 / size)
        for order in range(1, ORDER + 1):
            now = table.sum(axis=tuple(range(ORDER - order))) if order < ORDER else table
            seen, kinds = now.sum(-1, keepdims=True), (now > 0).sum(-1, keepdims=True)
            prob = np.where(seen > 0, (now + kinds * prob) / np.maximum(seen + kinds, 1), prob)
        self.cost = (-np.log(prob)).astype(np.float32)
        # what a symbol costs at least after another one, whatever stands before that
        self.least = self.cost.min(axis=tuple(range(ORDER - 2))).astype(np.float64)

    def code(self, letter: str) -> int:
        return self.index.get(letter, OTHER)


def word_grams(word: str, known: frozenset[str]) -> Iterator[str]:
    """The model's grams of a word."""
    plain = "".join(c if c in known else "?" for c in word)
    padded = " " * (ORDER - 1) + plain + " "
    return (padded[i : i + ORDER] for i in range(len(plain) + 1))


def is_read(c: str) -> bool:
    """Whether the channel may have written a letter as ``c``; all other characters are dropped."""
    return c.isalpha() or c in LOOK_ALIKE or c in MASKS


#: What a run may stand for: the letters that each place may be (None: any), and the channel's cost.
Reading = tuple[list[str | None], float]


def _readings(text: str) -> Iterator[list[Reading]]:
    """For each run of one character: what it may stand for, with costs."""
    i = 0
    while i < len(text):
        c, start, j = text[i], i, i + 1
        while j < len(text) and text[j] == c:
            j += 1
        n, i = j - i, j
        if c.isalpha():
            yield [([c], STRETCH_COST), ([c] * 2, STRETCH_COST)] if n > 2 else [([c] * n, 0.0)]
        elif c in LOOK_ALIKE:
            options: list[Reading] = [([LOOK_ALIKE[c]] * n, SIGN_COST * n)]
            for k in range(1, min(n, 3)):
                options += [([x] * k, SIGN_COST * k + STRETCH_COST) for x in LOOK_ALIKE[c]]
            if c in PUNCTUATION and (start == 0 or j == len(text)):
                options.append(([], DROP_COST))
            yield options
        elif c in MASKS:
            yield [([None] * n, MASK_COST * n), ([], (DROP_COST + 1.0) * n)]
        else:
            yield [([], DROP_COST)]


def restore(text: str, model: CharModel, words: bool = False) -> str:
    """The most likely sent text; with ``words`` it may fall into several words."""
    runs = list(_readings(text))
    if not words:  # no word can end between them
        runs = _merged(runs)
    # every path without masked letters bounds the best path
    found = _search([[r for r in readings if None not in r[0]] for readings in runs], model, words)
    if any(None in places for readings in runs for places, _ in readings):
        found = _search(runs, model, words, found[0], MANY) or (0.0, _search_array(runs, model, words))
    return found[1].strip()


def _merged(runs: list[list[Reading]]) -> list[list[Reading]]:
    """Runs that can be read in one way only, put together with such ones beside them."""
    found: list[list[Reading]] = []
    for readings in runs:
        if found and len(readings) == 1 == len(found[-1]):
            (places, channel), (more, cost) = found[-1][0], readings[0]
            found[-1] = [(places + more, channel + cost)]
        else:
            found.append(readings)
    return found


def _search(
    runs: list[list[Reading]], model: CharModel, words: bool, bound: float = math.inf, most: float = math.inf
) -> tuple[float, str] | None:
    """Cost and text of the best path, or None beyond ``most`` states.

    States are left out only if they cannot be part of a path within ``bound``:
    the rest of the text costs at least what ``_ahead`` says for their last symbol.
    """
    cost = model.cost
    codes = {x: [model.code(c) for c in x] for readings in runs for places, _ in readings for x in places if x}
    # without a bound nothing is left out
    ahead = _ahead(runs, model, codes, words) if bound < math.inf else None
    bound += 1e-6
    start = (BORDER,) * (ORDER - 1)
    layer: dict[tuple, tuple[float, str]] = {start: (0.0, "")}
    for number, readings in enumerate(runs):
        options: dict[tuple, tuple[float, str]] = {}
        for reading, (places, channel) in enumerate(readings):
            now = {s: (t + channel, o) for s, (t, o) in layer.items()}
            bounds = ahead[number][reading] if ahead else None
            for place, letters in enumerate(places):
                if len(now) == 1 and letters is not None and len(letters) == 1:
                    # one state and one letter: nothing to choose
                    ((state, (total, out)),) = now.items()
                    code = codes[letters][0]
                    now = {(*state[1:], code): (total + cost.item(*state, code), out + letters)}
                    continue
                after: dict[tuple, tuple[float, str]] = {}
                here, left = bounds[place : place + 2] if bounds else (None, None)
                for state, (total, out) in now.items():
                    if here is not None and total + here[state[-1]] > bound:
                        continue
                    row = cost[state]
                    if letters is None:
                        near = np.flatnonzero(row[2:] + left[2:] <= bound - total) if bounds else range(len(model.letters))
                        steps = [(int(i) + 2, model.letters[i]) for i in near]
                    else:
                        steps = zip(codes[letters], letters)
                    for code, x in steps:
                        t, to = total + float(row[code]), (*state[1:], code)
                        if to not in after or t < after[to][0]:
                            after[to] = (t, out + x)
                now = after
                if len(now) > most:
                    return None
            for state, best in now.items():
                if state not in options or best[0] < options[state][0]:
                    options[state] = best
        if words:
            for state, (total, out) in list(options.items()):
                total += float(cost[(*state, BORDER)]) + BREAK_COST
                if state != start and (start not in options or total < options[start][0]):
                    options[start] = (total, out + " ")
        layer = options
        if len(layer) > most:
            return None
    ends = ((t + float(cost[(*s, BORDER)]) if s != start else t, o) for s, (t, o) in layer.items())
    return min(ends, default=(math.inf, ""))


def _ahead(runs: list[list[Reading]], model: CharModel, codes: dict, words: bool) -> list[list[list[np.ndarray]]]:
    """For each run, reading and place: what the rest costs at least after each last symbol; the end comes last."""
    least = model.least
    after = least[:, BORDER].copy()  # a word ends; an empty one costs nothing
    after[BORDER] = 0.0
    found = []
    for number, readings in zip(reversed(range(len(runs))), reversed(runs)):
        if number == 0 and len(readings) == 1 and all(x is not None and len(x) == 1 for x in readings[0][0]):
            found.append([[]])  # one state goes through it
            break
        if words:
            after = np.minimum(after, least[:, BORDER] + BREAK_COST + after[BORDER])
        run, before = [], None
        for places, channel in readings:
            steps = [after]
            for letters in reversed(places):
                if letters is None:
                    steps.append((least[:, 2:] + steps[-1][2:]).min(1))
                else:
                    ways = [least[:, c] + steps[-1][c] for c in codes[letters]]
                    steps.append(ways[0] if len(ways) == 1 else np.minimum.reduce(ways))
            run.append(steps[::-1])
            total = steps[-1] + channel
            before = total if before is None else np.minimum(before, total)
        found.append(run)
        after = before
    return found[::-1]


def _search_array(runs: list[list[Reading]], model: CharModel, words: bool) -> str:
    """Text of the best path; the totals of all states are one array over the last three symbols."""
    size, cost = model.size, model.cost
    shape = (size,) * (ORDER - 1)
    start = (BORDER,) * (ORDER - 1)
    any_code = np.arange(2, size)
    # ends[state]: where a word ends after this state; a text may be empty
    ends = cost[..., BORDER].astype(np.float64)
    ends[start] = 0.0
    layer = np.full(shape, np.inf)
    layer[start] = 0.0
    # how each layer was reached: for each run, the steps of its readings, the reading taken, the state before a break
    trail: list[tuple[list[list[tuple[np.ndarray, str | None]]], np.ndarray, tuple | None]] = []
    for readings in runs:
        best, taken, all_steps = np.full(shape, np.inf), np.zeros(shape, np.int16), []
        for number, (places, channel) in enumerate(readings):
            now, steps = layer + channel, []
            for letters in places:
                codes = any_code if letters is None else np.unique([model.code(x) for x in letters])
                after, first = np.full(shape, np.inf), np.zeros(shape, np.int16)
                least, source = np.full((size, size, len(codes)), np.inf), np.zeros((size, size, len(codes)), np.int16)
                for a in np.flatnonzero(np.isfinite(now).any(axis=(1, 2))).tolist():
                    total = now[a][:, :, None] + cost[a][:, :, codes]
                    better = total < least
                    np.copyto(least, total, where=better)
                    source[better] = a
                after[:, :, codes], first[:, :, codes] = least, source
                now = after
                steps.append((first, letters))
            better = now < best
            np.copyto(best, now, where=better)
            taken[better] = number
            all_steps.append(steps)
        broken = None
        if words:
            total = best + cost[..., BORDER] + BREAK_COST
            total[start] = np.inf
            at = np.unravel_index(int(total.argmin()), shape)
            if total[at] < best[start]:
                broken, best[start] = tuple(map(int, at)), total[at]
        trail.append((all_steps, taken, broken))
        layer = best
    total = layer + ends
    state = tuple(map(int, np.unravel_index(int(total.argmin()), shape)))
    out: list[str] = []
    for all_steps, taken, broken in reversed(trail):
        if broken is not None and state == start:
            out.append(" ")
            state = broken
        for first, letters in reversed(all_steps[taken[state]]):
            code = state[-1]
            out.append(model.letters[code - 2] if letters is None else next(x for x in letters if model.code(x) == code))
            state = (int(first[state]), *state[:-1])
    return "".join(reversed(out))
