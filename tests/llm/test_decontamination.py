import re

import pytest

from shelfwise.llm import decontamination as d

from .conftest import ODD, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, items):
    """Every window of every item at every place of every document."""
    found = []
    for i, t in rows:
        w = WORD.findall(fold(t))
        hit, names = set(), set()
        for name, item in items:
            x = WORD.findall(fold(item))
            n = min(13, len(x))
            for k in range(len(x) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == x[k : k + n]:
                        hit.update(range(j, j + n))
                        names.add(str(name) if name is not None else "")
        found.append((i, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(found, key=str)


ITEMS = [
    (1, " ".join(words(50, 40))), (2, " ".join(words(51, 13))), (3, "Short item, here"), (4, None), (5, "..."), (None, "no NAME at all"),
    (10, " ".join(words(50, 40))), (6, "a a a"),
]
ROWS = [r for r in ODD if len(r[1] or "") < 10_000] + [
    (30, "Intro " + " ".join(words(50, 40)).upper() + " outro"), (31, " ".join(words(50, 40)[5:19])), (32, " ".join(words(50, 40)[5:17])),
    (33, "short ITEM-here " + " ".join(words(3, 100))), (34, " ".join([*words(4, 300), *words(51, 13)])), (35, "xshort item here"), (36, "a a a a b a a"),
    (37, "é".join(words(50, 40))), (38, "no name at all"),
]


@pytest.mark.parametrize("limit", [8_000_000, 300])
def test_against_brute_force(spark, make, limit):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = d.contamination(make(ROWS), items, automaton_bytes=limit).collect()
    got = sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got], key=str)
    assert got == brute(ROWS, ITEMS)
    kept = d.clean_documents(make(ROWS), items, automaton_bytes=limit)
    assert kept.columns == make(ROWS).columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted([g[0] for g in got if not g[4]], key=str)


def test_small_table(spark, small, small_rows):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in d.contamination(small, benchmark).collect()}
    for i, t in small_rows[:60]:
        w = f" {' '.join(WORD.findall(fold(t)))} "
        names = sorted(str(n) for n, x in items if any(f" {y.decode()} " in w for y in d.windows(x)))
        assert got[i][1] == names and (got[i][0] > 0) == bool(names)


def test_long_text_and_empty_tables(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    row = d.contamination(make([(7, "a " * 60_000)]), items).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (60_000, 60_000, ["6"])
    assert d.contamination(make([]), items).collect() == []
    empty = d.digest(d.contamination(make(ROWS), items.limit(0))).collect()
    assert len(empty) == len(ROWS) and not any(r["contaminated"] for r in empty)


def test_offsets_lead_to_the_original():
    text = "Ünter: Some-THING (new), é!"
    _, hits, _ = d.scan(d.build_automaton([("1", d.windows("thing new"))]), text)
    assert [text[a:b] for a, b in d.spans(text, hits)] == ["THING", "new"]
