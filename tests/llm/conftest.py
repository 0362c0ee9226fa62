import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) rows, with columns whose names operators use themselves."""

    def build(rows):
        data = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(data, SCHEMA)
        return df.selectExpr("*", *(f"'x' AS {c}" for c in ("id", "label", "hash", "shard", "row", "node", "score", "part")))

    return build


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r["doc_id"], r["text"]) for r in small.orderBy("doc_id").collect()]


def words(seed, n, size=300):
    """Invented words, the same for a seed."""
    r = random.Random(seed)
    return [f"w{r.randrange(size)}" for _ in range(n)]


#: Rows that every operator must stand: nulls, no words, ties, repeated rows, signs, long texts.
ODD = [
    (1, None), (2, ""), (3, "   \n \t"), (4, "one"), (5, "one"), (5, "one"), (None, "lost key"), (None, None), (6, "!!! ???"),
    (7, "a " * 60_000), (8, "x" * 150_000), (9, "日本語 текст 😀 ²Ⅷ\x1c\x85\xa0é"), (10, " ".join(words(1, 200))), (11, " ".join(words(1, 200))),
    (12, "1 " * 3_000), (13, "\n" * 500), (14, "mail me at joe.doe@mail.example.com or +1 (743) 555-3824 now"),
]
