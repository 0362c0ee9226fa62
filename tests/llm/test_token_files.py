import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import token_files
from shelfwise.llm.pieces import plain_splitter, split_plain

from .conftest import ODD

TRUTH = Tokenizer.from_file(token_files.TOKENIZER_FILE)


def check(got, rows):
    """Keys in order, numbers and checksums of the ids of their texts, and running starts."""
    got = sorted(map(tuple, got), key=lambda r: r[1])
    want = []
    for i, t in rows:
        ids = [*TRUTH.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted([(i, n, c) for i, _, n, c in got], key=str) == sorted(want, key=str)
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])][: len(got)]


@pytest.mark.parametrize("rows", [[*ODD, (20, "a <|endoftext|> b")], []])
def test_odd_rows(make, rows):
    check(token_files.token_files(make(rows)).collect(), rows)


def test_small_table(small, small_rows):
    check(token_files.token_files(small).collect(), small_rows)


def test_stripes_and_look_up(spark, small, small_rows, tmp_path):
    path = f"file://{tmp_path}/ids"
    token_files.write_tokens(small, path)
    names = sorted((tmp_path / "ids").glob("*.orc"))
    files = [pyarrow.orc.ORCFile(str(p)) for p in names]
    ids = [i for f in files for i in f.read(columns=["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(i for i, _ in small_rows)
    assert all(f.nrows == 0 or f.nstripes >= 1 for f in files) and {f.compression for f in files} == {"ZSTD"}
    found = token_files.read_tokens(spark, path).where("doc_id = 7")
    assert "EqualTo(doc_id,7)" in found._jdf.queryExecution().toString()
    assert found.first()["ids"][:-1] == TRUTH.encode(dict(small_rows)[7], add_special_tokens=False).ids
    assert b"doc_id" in names[0].read_bytes()


def test_added_tokens_are_those_of_the_untouched_library(make):
    """Unlike TRUTH, this tokenizer has the library's own settings."""
    untouched = Tokenizer.from_file(token_files.TOKENIZER_FILE)
    rows = [(1, "plain"), (2, "a <|endoftext|> b"), (3, "<|endoftext|>"), (4, "it's <|endoftext|>  ñ 語 12"), (5, "after")]
    want, start = [], 0
    for i, t in rows:
        ids = [*untouched.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert want[1][2] == 5
    assert sorted(map(tuple, token_files.token_files(make(rows)).collect())) == want


def test_generations_hold_within_a_batch(monkeypatch):
    """However many pieces a batch has, a worker keeps two generations of them; ids stay those of the library."""
    monkeypatch.setattr(token_files, "KEPT_PIECES", 10)
    with open(token_files.TOKENIZER_FILE, encoding="utf-8") as file:
        tokenizer = token_files.PieceTokenizer(file.read())
    words = " ".join(f"word{i} Ünï{i % 7} it's" for i in range(50))
    texts = [words, words, None, "", "x" * 100 + " " + "y" * 100, " 1  a\n\tb", "語 ñ\x00", "a <|endoftext|> b"]
    for _ in range(2):
        found = tokenizer.encode_batch(texts)
        assert [list(np.frombuffer(x, "<u4")) for x in found] == [TRUTH.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert 0 < len(tokenizer.kept) <= 10 and len(tokenizer.kept.older) <= 10


def test_a_block_asks_for_a_distinct_piece_once(monkeypatch):
    """Even where a worker keeps next to none of them."""
    monkeypatch.setattr(token_files, "KEPT_PIECES", 1)
    with open(token_files.TOKENIZER_FILE, encoding="utf-8") as file:
        tokenizer = token_files.PieceTokenizer(file.read())
    asked, ids = [], tokenizer.kept.model.ids
    monkeypatch.setattr(tokenizer.kept.model, "ids", lambda piece: asked.append(piece) or ids(piece))
    texts = [" one two  three it's" * 20, None, "", "three two" * 20]
    found = tokenizer.encode(pa.array(texts), 7).to_pylist()
    assert found == [[*TRUTH.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
    assert sorted(asked) == sorted(set(asked))


def test_plain_texts_are_split_as_by_the_pattern():
    signs, rng = [*"'''stmdrevlSTL bZéÿß09  \t\n\r\f\v!.-#\x00\x1c\x7f", "'ll", "'re", "n't", " '"], random.Random(5)
    texts = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(3000)]
    for some in (texts, [], ["", ""]):
        array = pa.array(["x'", *some, "ll"], pa.string()).slice(1, len(some))
        assert split_plain(array).to_pylist() == [plain_splitter()(t) for t in some]


def test_blocks_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 10)
    texts = ["a" * n for n in (1, 2, 3, 30, 1, 9, 1, 0, 4)] + [None, "é", "b" * 25, "c"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 4])], ["text"]) for i in range(0, len(texts), 4)]
    blocks = [b.column(0).to_pylist() for b in token_files.text_blocks(iter(batches), 0)]
    assert sum(blocks, []) == texts and 1 < len(blocks) < len(texts)
    for block in blocks:  # a block goes beyond the bound by no more than one text
        assert sum(len((t or "").encode()) for t in block[:-1]) < 10
    assert list(token_files.text_blocks(iter([batches[0].slice(0, 0)]), 0)) == []
