import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from shelfwise.llm import near_duplicates as n
from shelfwise.llm import shingles
from shelfwise.llm.components import components
from shelfwise.llm.shingles import word_hashes

from .conftest import ODD, words

FOLD = shingles._FOLD


def bag(text):
    """Shingles of a text with counts, from its words."""
    w = (text or "").encode().translate(FOLD).split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    """By the definition, every d against every d'."""
    both, union = a.keys() & b.keys(), a.keys() | b.keys()
    return sum(1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in union) for d in both)


def brute(rows):
    """Classes from all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [bag(t) for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        s, t = rows[i][1], rows[j][1]
        if bags[i] and bags[j]:
            near = len(bags[i].keys() & bags[j].keys()) * 2 > min(len(bags[i]), len(bags[j])) and probability_jaccard(bags[i], bags[j]) >= 0.8
        else:
            near = not bags[i] and not bags[j] and s is not None and s == t
        if near:
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    least = {k: min((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return sorted(((i, least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def edited(base, seed, changes):
    r, out = random.Random(seed), list(base)
    for k in r.sample(range(len(out)), changes):
        out[k] = f"new{r.randrange(10**6)}"
    return " ".join(out)


def got(df, **params):
    return sorted(map(tuple, n.classes(df, **params).collect()), key=str)


def test_hashes_tell_words_apart():
    texts = ["the The THE, tHe", "a" * 3_000_000 + " b", "x y " * 400_000, "", None, "é e"]
    hashes, offsets = word_hashes(texts)
    assert np.diff(offsets).tolist() == [4, 2, 800_000, 0, 0, 2]
    assert len(set(hashes[:4].tolist())) == 1 and len(set(hashes[6:800_006].tolist())) == 2
    assert hashes[6] == word_hashes(["x"])[0][0]


def test_similarity_is_exact():
    for seed in range(8):
        r = random.Random(seed)
        a, b = (Counter(r.randrange(60) for _ in range(200)) for _ in range(2))
        pack = lambda c: (np.array(sorted(c)), np.array([c[k] for k in sorted(c)]))
        assert n.similarity(pack(a), pack(b)) == pytest.approx(probability_jaccard(a, b))


def test_signatures_estimate_similarity():
    base = words(1, 400)
    texts = [" ".join(base), edited(base, 2, 8), edited(base, 3, 30), " ".join(base[:200] * 2), " ".join(words(9, 400))]
    sets = n._weighted(texts)
    number = np.concatenate([np.full(len(s[0]), i) for i, s in enumerate(sets)])
    signs = n.signatures(number, np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), len(sets))
    for i, j in combinations(range(len(texts)), 2):
        assert (signs[i] == signs[j]).mean() == pytest.approx(n.similarity(sets[i], sets[j]), abs=0.16)


def test_odd_rows_and_copies(make):
    base, other = words(5, 300, 5000), words(6, 120, 5000)
    rows = [r for r in ODD if len(r[1] or "") < 10_000] + [(40, " ".join(base)), (41, " ".join(base).upper() + "!")]
    rows += [(50 + k, edited(base, k, 6)) for k in range(12)] + [(70 + k, edited(other, k, 3)) for k in range(8)]
    rows += [(90, "one"), (91, " ".join(words(7, 300, 5000)))]
    assert got(make(rows)) == brute(rows)


def test_small_table(small, small_rows):
    assert got(small) == brute(small_rows)


def test_keys_tell_nothing_of_the_text(make):
    """Rows of one key with different texts lie in the classes of their texts; so do null keys and long texts."""
    a, b = words(21, 300, 5000), words(22, 300, 5000)
    long = " ".join(words(23, 1_200, 9000))
    rows = [(1, " ".join(a)), (1, " ".join(b)), (0, edited(a, 1, 4)), (2, edited(b, 2, 4)), (None, edited(b, 3, 4)), (3, None), (3, None),
            (7, long), (6, long + " end"), (8, "x" * 150_000), (9, "a " * 60_000), (None, "a " * 60_000), (None, "lost")]
    df = make(rows)
    assert got(df) == brute(rows)
    assert got(df)[:4] == [(0, 0), (1, 0), (1, 1), (2, 1)]
    kept = [(r["doc_id"], r["text"]) for r in n.representatives(df).collect()]
    want = [rows[2], rows[1], (3, None), (6, long + " end"), (8, "x" * 150_000), (9, "a " * 60_000), (None, "lost")]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_chain_without_a_hub(make):
    """Each text is near the one before only, so a leader alone would lose links."""
    text, rows = words(8, 200, 5000), []
    for k in range(12):
        rows.append((100 - k, " ".join(text)))
        text = edited(text, k, 3).split()
    found = brute(rows)
    assert got(make(rows)) == found and len({c for _, c in found}) == 1


def test_blocks_find_what_leaders_miss(make, monkeypatch):
    monkeypatch.setattr(n, "BLOCK", 3)
    base = words(11, 150, 5000)
    rows = [(k, edited(base, k // 2, 8 + k % 2)) for k in range(30)]
    assert got(make(rows)) == brute(rows)


def test_one_row_of_each_class_stays(make):
    base = words(5, 100, 5000)
    rows = [(1, " ".join(base)), (2, edited(base, 1, 1)), (3, " ".join(words(6, 100, 5000))), (3, " ".join(words(6, 100, 5000))), (None, "x"), (4, None), (5, None)]
    kept = n.representatives(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted([1, 3, None, 4, 5], key=str)


def test_empty_table(make):
    assert n.classes(make([])).collect() == [] == n.representatives(make([])).collect()


def test_components(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 300)] + [(r.randrange(400, 700), r.randrange(400, 700)) for _ in range(250)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in linked)
