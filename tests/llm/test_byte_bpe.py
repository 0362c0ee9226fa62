import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import byte_bpe
from shelfwise.llm.pieces import is_plain

from .conftest import ODD

with open(byte_bpe.RANK_FILE, "rb") as _file:
    CODEC = byte_bpe.build_codec(_file.read())
TRUTH = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def ids(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aetzhß'1 \n\t-=²Ⅷ\x1c\x85\xa0日é😀", "th", "  ", "'ll"]), max_size=80).map("".join))
def test_ids_of_any_text(text):
    assert ids(text) == TRUTH.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()
    if is_plain(text):
        assert CODEC.plain_split(text) == CODEC.split(text)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 50_255), st.integers(0, 50_255))
def test_compatible_pairs(a, b):
    merged = [CODEC.ranks[p] for p in CODEC.merge(CODEC.tokens[a] + CODEC.tokens[b])]
    assert CODEC.compatible(a, b) == (merged == [a, b])


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 50_000, "ab" * 40_000, "=" * 30_000, "日" * 20_000])
def test_long_pieces(text):
    assert ids(text) == TRUTH.encode_ordinary(text)


@pytest.mark.parametrize("rows", [ODD, []])
def test_round_trip(make, rows):
    got = sorted(map(tuple, byte_bpe.round_trip(make(rows)).collect()), key=str)
    want = []
    for i, t in rows:
        x = np.array(TRUTH.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(small, small_rows):
    decoded = byte_bpe.decode(byte_bpe.encode(small)).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in decoded} == dict(small_rows)


def test_tokenized(make):
    got = byte_bpe.tokenized(make(ODD)).where("doc_id = 14").first()
    assert got["ids"] == TRUTH.encode_ordinary(dict(ODD)[14]) and got["n_tokens"] == len(got["ids"])
