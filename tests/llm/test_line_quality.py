import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import line_quality as q

from .conftest import ODD, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The base counts as they are defined."""
    text = text or ""
    w = WORD.findall(text)
    times = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if times[t] > 1 for k in range(3)}
    lines = text.split("\n")
    duplicates = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(inside)


@pytest.mark.parametrize("seed", range(30))
def test_base_counts(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["a", "b", "a b a", " ", "\n", "\t", "\x1c", "\xa0", "é", "#", "*|", "日", "\r", "x\ny\n", "a b\n"]) for _ in range(r.randrange(60)))
    assert q.base_counts(text) == brute(text)


def field(seed=0):
    r = np.random.default_rng(seed)
    return q.LineField(r.normal(size=(q.FEATURES, 2)), r.normal(size=(2, 2)))


def test_viterbi_is_the_best_labelling():
    """Against all labellings of short texts."""
    for seed in range(6):
        model = field(seed)
        rows, _ = q.line_features("Some line here.\n### | junk | $$$\nSome line here.\n\nABC!! DEF!! GHI!!\nend")
        scores = model.weights[rows].sum(1)

        def total(labels):
            return sum(scores[i, y] for i, y in enumerate(labels)) + sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(rows)), key=total)
        assert model.decode(rows).tolist() == list(best)


def test_fit_raises_the_likelihood_of_the_labels():
    chains = [q.line_features(t)[0] for t in ("Fine words stand here.\nMore of them.", "$$$ ### |||\n### $$$ &&&")] * 5
    model = q.LineField()
    model.fit(chains, [1, 0] * 5)
    assert model.decode(chains[0]).all() and not model.decode(chains[1]).any()


def corpus():
    rows, labels = [], []
    for i in range(160):
        w = words(i, 120, 5000)
        good = i % 4 != 0
        text = "\n".join(" ".join(w[k : k + 12]).capitalize() + "." for k in range(0, 120, 12)) if good else " ".join(f"{x}$$$" if k % 2 else f"{x}###" for k, x in enumerate(w))
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame([(i, y, 0) for i, y in labels], "doc_id bigint, quality int, toxic int")


def test_quality(spark, make):
    rows, labels = corpus()
    got = {r["doc_id"]: r for r in q.quality(make(rows), table(spark, labels[:80])).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(text)
        assert r["base_failed"] is False and r["kept"] == bool(dict(labels)[i])


def test_odd_rows(spark, make):
    rows, labels = corpus()
    got = sorted(q.quality(make(rows[:20] + ODD), table(spark, [*labels, (None, 1), (5, None)])).collect(), key=str)
    assert len(got) == 20 + len(ODD)
    short = {i: t for i, t in ODD if len(t or "") < 10_000 and i not in (None, 5)}
    for r in got:
        if r["doc_id"] in short and r["doc_id"] > 20:
            assert r["n_words"] == brute(short[r["doc_id"]])[0]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_empty_tables(spark, make):
    assert q.quality(make([]), table(spark, [])).collect() == []
    r = q.quality(make([(1, " ".join(words(3, 80, 5000)))]), table(spark, [])).first()
    assert r["kept"] and r["content_share"] == 1.0
