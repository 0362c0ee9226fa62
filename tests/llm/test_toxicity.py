import math
import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import toxicity as t
from shelfwise.llm.deobfuscation import CharModel, restore, word_grams

from .conftest import ODD

BAD = ("moron", "idiot", "scum")


def corpus(n=400):
    """Clean and toxic rows of invented words; half of the toxic words are disguised."""
    r = random.Random(1)
    names = ["".join(r.choice(["an", "er", "th", "on", "in", "re", "ha"]) for _ in range(r.randrange(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(names) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            word = r.choice(BAD)
            w[r.randrange(40)] = r.choice([word, word, word.replace("o", "0").replace("i", "1"), " ".join(word), ".".join(word), word[0] + word[1] * 4 + word[2:]])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id bigint, quality int, toxic int")


def model_of(words):
    grams = {}
    known = frozenset("abcdefghijklmnopqrstuvwxyz")
    for w in words:
        for g in word_grams(w, known):
            grams[g] = grams.get(g, 0) + 1
    return CharModel("abcdefghijklmnopqrstuvwxyz", list(grams), list(grams.values()))


MODEL = model_of(["idiot", "moron", "scum", "stupid", "the", "other", "thing", "and"] * 3)


@pytest.mark.parametrize(
    ("seen", "sent"),
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("$cum", "scum"), ("st*pid", "stupid"), ("i.d.i.o.t", "idiot"), ("m-o-r-o-n", "moron"), ("stuuuupid", "stupid"), ("moron", "moron")],
)
def test_restored_words(seen, sent):
    assert restore(seen, MODEL) == sent


def test_spaced_letters_fall_into_words():
    assert restore("t h e i d i o t", MODEL, words=True).replace(" ", "") == "theidiot"


def test_viterbi_is_the_best_path():
    """Against all readings of a short lattice."""
    import itertools

    from shelfwise.llm.deobfuscation import ORDER, SIGN_COST

    best = min(
        (sum(MODEL.cost[tuple(MODEL.code(c) if c != " " else 0 for c in padded[i : i + ORDER])] for i in range(len(word) + 1)), word)
        for letters in itertools.product("m", "o", "r", "o", "n") for word in ["".join(letters)] for padded in [" " * (ORDER - 1) + word + " "]
    )
    assert restore("m0r0n", MODEL) == best[1] and SIGN_COST > 0
    two = [(sum(MODEL.cost[tuple(MODEL.code(c) if c != " " else 0 for c in p[i : i + ORDER])] for i in range(len(w) + 1)), w) for w in ("id", "ld") for p in ["   " + w + " "]]
    assert restore("1d", MODEL) == min(two)[1]


def test_model_is_a_distribution():
    assert np.allclose(np.exp(-MODEL.cost.astype(np.float64)).sum(-1), 1, atol=1e-4)


def test_places_of_disguise():
    raw = "the m0r0n and $cum, a b c d e; loooser it's 12 x2 fine".encode()
    found = {raw[a:b].decode() for a, b, _ in t.disguised(raw)}
    assert {"m0r0n", "$cum,", "loooser"} <= found and "fine" not in found and "12" not in found
    assert any(spaced for _, _, spaced in t.disguised(b"so a b c d now"))


def test_scores(spark, make):
    rows, labels = corpus()
    got = {r["doc_id"]: r for r in t.toxicity(make(rows), table(spark, labels)).collect()}
    held = {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in got.items() if r["held_out"]} == held
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    right = [got[i]["predicted"] == y for i, y in labels if i in held]
    assert np.mean(right) > 0.95
    # labels of held-out rows change nothing
    other = [(i, 1 - y if i in held else y) for i, y in labels]
    again = {r["doc_id"]: r["score"] for r in t.toxicity(make(rows), table(spark, other)).collect()}
    assert all(math.isclose(again[i], got[i]["score"], rel_tol=1e-6) for i in again)
    kept = t.without_toxic(make(rows), table(spark, labels))
    assert kept.columns == make(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if not r["predicted"])


def test_odd_rows(spark, make):
    _, labels = corpus(12)
    got = t.toxicity(make(ODD), table(spark, [*labels, (None, 1), (5, None)])).collect()
    assert sorted([r["doc_id"] for r in got], key=str) == sorted([i for i, _ in ODD], key=str)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3, None)}) == 1


def test_empty_tables(spark, make):
    assert t.toxicity(make([]), table(spark, [])).collect() == []
    assert [r["predicted"] for r in t.toxicity(make([(1, "some text")]), table(spark, [])).collect()] == [0]


@pytest.mark.parametrize(
    "seen",
    ["worthle55", "a55", "!diot", "(lown", "+rash", "*diot", '"$cum"', "f€ck", "f£ock", "i d i o t", "i\nd\ni\no\nt", "i \t d  i o t", "é t é", '"i d i o t."', "moron!", "i'd'i'o't"],
)
def test_more_places_of_disguise(seen):
    raw = f"so {seen} there".encode()
    assert seen in {raw[a:b].decode() for a, b, _ in t.disguised(raw)}
    assert not t.disguised("so 12 'fine' words, हिन्दी, there.".encode())


@pytest.mark.parametrize(
    ("seen", "sent"),
    [("!diot", "idiot"), ("*diot", "idiot"), ('"$cum"', "scum"), ("m\no\nr\no\nn", "moron"), ("(moron)", "moron"), ("moron!", "moron"), ("$tup1d!!", "stupid")],
)
def test_restored_places(seen, sent):
    assert sent in t.restore_text(f"so {seen} there", MODEL, {}).split()


def brute(text, model):
    """Least cost over all sent words, each path's cost added up letter by letter."""
    import itertools

    from shelfwise.llm import deobfuscation as d

    best = math.inf, ""
    for path in itertools.product(*d._readings(text)):
        channel = sum(c for _, c in path)
        for letters in itertools.product(*[x or model.letters for places, _ in path for x in places]):
            codes = [0, 0, 0, *map(model.code, letters)]
            total = channel + sum(float(model.cost[tuple(codes[i : i + 4])]) for i in range(len(letters)))
            total += float(model.cost[(*codes[-3:], 0)]) if letters else 0
            best = min(best, (total, "".join(letters)))
    return best[1]


@pytest.mark.parametrize("seen", ["m*r*n", "m**n", "sc*m", "*d10*", "1*1", "11", "111d", "s*!", "$$*m", "***"])
def test_masked_words_against_all_paths(seen):
    assert restore(seen, MODEL) == brute(seen, MODEL)


def test_runs_of_masks_are_as_long_as_the_run():
    assert restore("s****d", MODEL) == "stupid" and restore("m***n", MODEL) == "moron"


def test_both_searches_agree():
    from shelfwise.llm import deobfuscation as d

    for text in ("1d10t", "$cum", "i.d.i.o.t", "stuuupid", "t h e i d 1 o t", "m0r0n 1d", "m**n", "id*ot!", "t h * i d*"):
        for spaced in (False, True):
            assert restore(text, MODEL, spaced) == d._search_array(list(d._readings(text)), MODEL, spaced).strip()


def test_alphabet_is_that_of_the_corpus(spark, make):
    model = t.char_model(make([(i, "идиот дурак привет мир абвгдежзийклмнопрстуфхцчшщъыьэюя") for i in range(20)]))
    assert restore("ид*от", model) == "идиот"
