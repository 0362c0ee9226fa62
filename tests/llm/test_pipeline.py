import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm import pii

from .conftest import SMALL
from .test_byte_bpe import TRUTH
from .test_decontamination import brute as contaminated
from .test_near_duplicates import brute as classes

NAMES = ["toxicity", "near duplicates", "decontamination", "personal data", "byte-level BPE"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs.collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/out"
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        assert name == NAMES[-1] or docs.columns == columns
        found.append(docs.collect())
    return found


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_toxic_documents_go(spark, stages):
    scores = entry.queries()["op6_toxicity"](spark, SMALL).collect()
    assert {r["doc_id"] for r in stages[1]} == {r["doc_id"] for r in scores if not r["predicted"]}


def test_one_document_of_each_class_stays(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[1])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted({c for _, c in classes(rows)})


def test_contaminated_documents_go(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    short = [(r["doc_id"], r["text"]) for r in stages[2] if len(r["text"]) < 1500]
    want = {r[0] for r in contaminated(short, items) if not r[4]}
    assert {r["doc_id"] for r in stages[3]} & {i for i, _ in short} == want


def test_personal_data_is_redacted(stages):
    before = {r["doc_id"]: r for r in stages[3]}
    assert {r["doc_id"] for r in stages[4]} == set(before)
    changed = [r for r in stages[4] if r["text"] != before[r["doc_id"]]["text"]]
    assert changed
    for r in stages[4]:
        assert pii.base_spans(r["text"]) == []
        if r in changed:
            assert r["n_chars"] == len(r["text"])


def test_last_stage_encodes_every_text(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert {r["doc_id"] for r in stages[5]} == set(texts)
    for r in stages[5]:
        assert r["ids"] == TRUTH.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
