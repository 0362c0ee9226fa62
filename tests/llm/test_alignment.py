import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfwise.llm import alignment
from tests.llm.conftest import ODD

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
GIVEN = (open(alignment.FIRST, encoding="utf-8").read(), open(alignment.SECOND, "rb").read())
FIRST_BYTES, SECOND_BYTES = alignment.first_bytes(GIVEN[0]), alignment.second_bytes(B)
SPECIAL = ["<|endoftext|>", "a <|endoftext|> b", "<s> </s> <unk>", "U+2581 ▁ here", "  two  blanks ", " ", "\n", "a \n b\n\n  c", "x\x1c y\x85 z\xa0 w", "don't we'll  it's"]


def whole(text):
    """Ids of both tokenizers on the whole text, or none, and the groups between their common ends."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    data = (" " + text).encode()
    if not text or b"".join(FIRST_BYTES[i] for i in a) != data or b"".join(SECOND_BYTES[i] for i in b) != data:
        return [], [], []

    def ends(ids, table):
        at, found = 0, {}
        for n, i in enumerate(ids):
            at += len(table[i])
            found[at] = n + 1
        return found

    ea, eb = ends(a, FIRST_BYTES), ends(b, SECOND_BYTES)
    groups, i, j = [], 0, 0
    for cut in sorted(ea.keys() & eb.keys()):
        groups.append((a[i : ea[cut]], b[j : eb[cut]]))
        i, j = ea[cut], eb[cut]
    return a, b, groups


def brute(rows):
    """The contract's columns by whole texts and one counter of pairs."""
    found = [(i, *whole(t or "")) for i, t in rows]
    pairs = Counter((x[-1], y[-1]) for *_, groups in found for x, y in groups)
    most = Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    out = []
    for i, a, b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        best = sum(pairs[p] == most[p[1]] for p in links)
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(pairs[p] for p in links), sha))
    return sorted(out, key=str)


def result(df, **params):
    return sorted(map(tuple, alignment.alignment(df, **params).collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["the", " word", "  ", "\n", "'s", "日本", "é", "<|endoftext|>"])), max_size=12))
def test_units_give_the_ids_of_the_whole_text(parts):
    text = "".join(parts)
    aligner = test_units_give_the_ids_of_the_whole_text.aligner
    a, b, groups = whole(text)
    cut = alignment.CUT.split(" " + text) if text else []
    units = [aligner.units([cut])[u] for u in cut]
    if None in units or not text:
        assert not a and not b
    else:
        assert (sum(u.n_a for u in units), sum(u.n_b for u in units)) == (len(a), len(b))
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert "".join(u.written for u in units)[:-1] == shown


test_units_give_the_ids_of_the_whole_text.aligner = alignment.Aligner(GIVEN)


def test_generations_keep_what_was_met_last(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_UNITS", 3)
    aligner = alignment.Aligner(GIVEN)
    for text in ([" a", " b"], [" a", " c", " d"], [" a", " e"], [" f", " g", " h", " i"]):
        assert set(aligner.units([text])) == set(text)
        assert len(aligner.new) <= 3 + 4 and len(aligner.old) <= 3 + 4


def test_same_bytes_links_are_groups_of_one():
    aligner = alignment.Aligner(GIVEN)
    for text in (" the house", " worthwhile 12.5", " naïve 日本語"):
        _, _, groups = whole(text[1:])
        for x, y in groups:
            if FIRST_BYTES[x[-1]] == SECOND_BYTES[y[-1]]:
                assert len(x) == len(y) == 1
    assert sum(aligner.same >= 0) > 15_000


@pytest.mark.parametrize("rows", [[*ODD, *((100 + i, t) for i, t in enumerate(SPECIAL))], []])
def test_odd_rows(make, rows):
    got = result(make(rows))
    assert got == brute(rows)
    empty = [g for g in got if g[0] in (1, 2)]
    assert all(g[1:] == (0, 0, 0, 0, 0, 0, "") for g in empty)


def test_documents(small, small_rows):
    want = brute(small_rows)
    assert result(small) == want == result(small.repartition(5))


def test_hot_pairs(make, monkeypatch):
    """One pair holds a third of all links; looked-up and shuffled pairs give the same sums."""
    r = random.Random(3)
    rows = [(i, " ".join(["zzyx"] * 20 + [f"w{r.randrange(200)}q" for _ in range(20)])) for i in range(60)]
    want = brute(rows)
    assert result(make(rows)) == want
    monkeypatch.setattr(alignment, "HEAVY_SHARE", 0.2)
    assert result(make(rows)) == want
    monkeypatch.setattr(alignment, "TASK_PAIRS", 5)
    assert result(make(rows)) == want
