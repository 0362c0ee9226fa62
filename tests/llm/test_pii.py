import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import pii
from shelfwise.llm.semi_crf import KINDS, SemiCrf, candidates, luhn, tokens_of

from .conftest import ODD

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MODEL = pii.train([])


def brute(text):
    """The patterns as they stand, with their checks."""
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            n = len(re.sub("[^0-9]", "", m[0]))
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) < 256 for p in m[0].split(".")),
                "card": lambda m=m, n=n: 14 <= n <= 19 and luhn(re.sub("[^0-9]", "", m[0])),
                "phone": lambda n=n: 10 <= n <= 15,
            }[kind]
            if good():
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


PIECES = ["@", "a", "b.c", ".", "1", "12", "255", "256", "4111111111111111", " ", "-", "+", "(", ")", "a@b.co", "1.2.3.4", "+1 555 123 4567", "\n", "é", "007"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans(text):
    base, spans = pii.find_spans(text, MODEL)
    assert base == brute(text) and set(base) <= set(spans)
    more = [s for s in spans if s not in base]
    assert all(b <= c or a >= d for _, a, b in more for _, c, d in base)


def test_long_runs_are_linear():
    for text in ("1" * 60_000, "a" * 200_000 + "@", "a." * 60_000, "+1" * 20_000):
        assert pii.base_spans(text) == []


@pytest.mark.parametrize(
    ("text", "kind", "entity"),
    [
        ("please call (743) 555-3824 now", "phone", "(743) 555-3824"),
        ("write to joe at mail dot com soon", "email", "joe at mail dot com"),
        ("write to joe.doe(at)mail.com soon", "email", "joe.doe(at)mail.com"),
        ("two cards 4111111111111111 4012888888881881 here", "card", "4012888888881881"),
    ],
)
def test_spellings_beyond_the_patterns(text, kind, entity):
    at = text.index(entity)
    assert (kind, at, at + len(entity)) in pii.find_spans(text, MODEL)[1]


@pytest.mark.parametrize("text", ["on 2024-01-05 at noon", "version 1.2.3 of it", "number 9807915767101644 only", "they met at the old house", "3.14159 and 2,500.00"])
def test_clean_texts_stay_clean(text):
    assert pii.find_spans(text, MODEL) == ([], [])


def test_held_out_regions():
    generator = pii.Generator([])
    generator.random.seed(77)
    right = wrong = missed = 0
    for _ in range(150):
        text, gold = generator.region()
        found = set(MODEL.decode(text))
        right, wrong, missed = right + len(found & set(gold)), wrong + len(found - set(gold)), missed + len(set(gold) - found)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_decoding_is_the_best_labelling():
    """Against all ways to lay entities over a short region."""
    text = "a 10.1.2.3 4111111111111111"
    tokens = tokens_of(text)
    segments = candidates(text, tokens)
    scores = MODEL._scores(segments)

    def best(at, state):
        if at == len(tokens):
            return 0.0, []
        total, found = best(at + 1, 0)
        options = [(total + MODEL.moves[state, 0], found)]
        for k, s in enumerate(segments):
            if s.start == at:
                total, found = best(s.end, 1)
                kind = int(scores[k].argmax())
                options.append((total + MODEL.moves[state, 1] + scores[k, kind], [(KINDS[kind], tokens[at][0], tokens[s.end - 1][1]), *found]))
        return max(options, key=lambda x: x[0])

    assert MODEL.decode(text) == best(0, 0)[1]


def test_gradient_is_that_of_the_likelihood():
    """The expected counts sum to one labelling: pushing up all spans of a kind evenly changes nothing else."""
    text = "to 10.1.2.3 or 4111111111111111"
    tokens, field = tokens_of(text), SemiCrf()
    segments = candidates(text, tokens)
    spans, moves = field.gradient(len(tokens), segments, {})
    entities = -spans.sum()
    assert 0 < entities and moves[:, 1].sum() == pytest.approx(-entities)


def test_queries_rows(make):
    got = sorted(pii.personal_data(make(ODD), model=MODEL).collect(), key=str)
    want = {str((i, t)): brute(t) for i, t in ODD}
    hashes = sorted(hashlib.sha256(pii.joined(s).encode()).hexdigest() for s in want.values())
    assert sorted({r["base_sha256"] for r in got}) == sorted(set(hashes)) and len(got) == len(ODD)
    row = next(r for r in got if r["doc_id"] == 14)
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 0, 0, 1)
    assert row["spans"] == "email:11:35,phone:39:56"


def test_redaction(make):
    out = pii.redact(make(ODD), model=MODEL)
    assert out.columns == make(ODD).columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[14]["text"] == "mail me at [EMAIL] or [PHONE] now" and rows[14]["n_chars"] == len(rows[14]["text"])
    assert rows[1]["text"] is None and rows[10]["text"] == dict(ODD)[10]
    assert pii.redact_text("abcdef", "ip:1:4,card:2:5") == "a[IP]f"


def test_empty_table(make):
    assert pii.personal_data(make([])).collect() == []
