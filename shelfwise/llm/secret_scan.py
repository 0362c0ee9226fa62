"""Secrets in texts: candidates sifted by a random forest.

Candidates are long runs of key characters that hold a digit, tokens joined by dots,
and every value that is assigned to a secret's name. The forest reads
their length, character transitions, coverage by dictionary words, the path they
stand in and the words around them, and removes what only looks like a secret.
It is trained by Spark's own library on labelled findings.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, map_text, materialize, prepare, string_type

MIN_LENGTH = 16
#: Findings of the corpus and generated ones that the forest is trained on, at most; dictionary words.
CORPUS_FINDINGS, GENERATED_FINDINGS, DICTIONARY_WORDS = 10_000, 3_000, 5_000
TREES, DEPTH, SEED = 30, 8, 7
THRESHOLD = 0.5
#: Characters read before and after a candidate.
AROUND = 40

_KEY = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
#: Words that name a secret, and words that name something else.
SECRET_WORDS = ("token", "secret", "key", "apikey", "password", "passwd", "auth", "bearer", "credential", "private")
OTHER_WORDS = ("commit", "sha", "hash", "checksum", "digest", "id", "uuid", "version", "order", "card", "isbn", "phone", "example")
_ASSIGNED = re.compile(r"[:=]\s*[\"'`]?$")
_NAME = re.compile(r"[A-Za-z_][\w-]*$", re.ASCII)
#: A value after a secret's name: in quotes as it stands, else up to white space or a quote.
_VALUE = re.compile(
    rf"(?:(?:{'|'.join(SECRET_WORDS)})[\w-]{{0,40}}[\"'`]?\s*(?::=|=>|[:=])\s*(?:bearer\s+)?|\bbearer\s+)"
    r"(?:\"([^\"\n]+)\"|'([^'\n]+)'|`([^`\n]+)`|([^\s\"'`]+))",
    re.IGNORECASE,
)
#: Tokens joined by dots; what follows an at-sign is the host of an address.
_DOTTED = re.compile(r"(?<![A-Za-z0-9+/=_.@-])[A-Za-z0-9+/=_-]+(?:\.[A-Za-z0-9+/=_-]+)+")
NAMES = (
    "length", "digits", "upper", "lower", "signs", "entropy", "distinct", "hex", "longest_digits", "longest_letters",
    "to_digit", "to_letter", "case_changes", "vowels", "dictionary", "slashes", "dashes", "equals_end", "in_path",
    "path_depth", "quoted", "assigned", "secret_word", "other_word", "word_distance", "prefix",
)


def candidate_spans(raw: bytes) -> list[tuple[int, int]]:
    """Byte ranges of runs of key characters, long enough and with a digit."""
    chars = np.frombuffer(raw, np.uint8)
    edges = np.diff(_KEY[chars].view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= MIN_LENGTH
    return [(a, b) for a, b in zip(starts[long].tolist(), ends[long].tolist()) if _DIGIT[chars[a:b]].any()]


def _value_start(run: str) -> int:
    """Where the value of a run NAME=value starts; 0 without a name. Padding at the end is no assignment."""
    at = run.find("=")
    return at + 1 if at > 0 and run[at + 1 : at + 2] not in ("", "=") and _NAME.search(run[:at]) else 0


def proposed_spans(text: str) -> list[tuple[int, int]]:
    """Candidates of a text in code points, in order: runs without their names, dotted tokens, assigned values."""
    raw = text.encode("utf-8", "surrogatepass")
    found, at, place = set(), 0, 0
    for a, b in candidate_spans(raw):
        place += len(raw[at:a].decode("utf-8", "surrogatepass"))
        at = a
        found.add((place + _value_start(text[place : place + b - a]), place + b - a))
    for m in _DOTTED.finditer(text):
        start = m.start() + _value_start(m[0])
        if m.end() - start >= MIN_LENGTH:
            found.add((start, m.end()))
    from_ = 0
    while m := _VALUE.search(text, from_):
        a, b = m.span(m.lastindex)
        from_ = b
        if m.lastindex == 4:
            b = a + len(text[a:b].rstrip(",;.)]}>"))
            if m.start() and "&" in text[a:b] and re.search(r"[?&][\w.-]{0,80}$", text[max(0, m.start() - 81) : m.start()]):
                from_ = b = text.index("&", a)  # a query string: the next parameter may be a secret too
        if b > a:
            found.add((a, b))
    return sorted(found)


def build_dictionary(words: list[str]) -> ahocorasick.Automaton:
    """Automaton of dictionary words, in lower case."""
    found = ahocorasick.Automaton()
    for w in words:
        found.add_word(w, len(w))
    found.make_automaton()
    return found


def _covered(text: str, dictionary: ahocorasick.Automaton) -> float:
    """Share of the characters that dictionary words cover."""
    if not len(dictionary):
        return 0.0
    edge = np.zeros(len(text) + 1, np.int64)
    for end, n in dictionary.iter(text):
        edge[end - n + 1] += 1
        edge[end + 1] -= 1
    return float((np.cumsum(edge[:-1]) > 0).mean())


def features(text: str, before: str, after: str, dictionary: ahocorasick.Automaton) -> list[float]:
    """Numbers of one candidate, in the order of NAMES."""
    n = len(text)
    counts = Counter(text)
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else "." for c in text)
    moves = Counter(zip(kinds, kinds[1:]))
    lower = text.lower()
    words = re.findall(r"[^\W\d_]+", before.lower())[-4:]
    longest = lambda pattern: max(map(len, re.findall(pattern, text)), default=0)
    secret = [len(words) - i for i, w in enumerate(words) if w in SECRET_WORDS]
    path = re.search(r"\S*$", before)[0] + text
    return [
        float(min(n, 400)), kinds.count("9") / n, kinds.count("A") / n, kinds.count("a") / n, kinds.count(".") / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()), len(counts) / n,
        float(all(c in "0123456789abcdef" for c in lower)), float(longest("[0-9]+")), float(longest("[A-Za-z]+")),
        sum(v for (a, b), v in moves.items() if a != "9" and b == "9") / n,
        sum(v for (a, b), v in moves.items() if a == "9" and b != "9") / n,
        sum(v for (a, b), v in moves.items() if {a, b} == {"A", "a"}) / n,
        sum(lower.count(v) for v in "aeiou") / n, _covered(lower, dictionary), float(text.count("/")), float(text.count("-")),
        float(len(text) - len(text.rstrip("="))), float("/" in path or "\\" in path), float(path.count("/")),
        float(after[:1] in "\"'`" and after != ""), float(bool(_ASSIGNED.search(before))), float(bool(secret)),
        float(any(w in OTHER_WORDS for w in words)), float(min(secret, default=9)),
        float(bool(re.match(r"(?:AKIA|ASIA|ghp_|gho_|xox[bap]-|sk-|sk_live_|AIza|eyJ)", text))),
    ]


def label_rule(text: str, before: str) -> int | None:
    """Label of a finding that is plain: 1 assigned to a secret's name, 0 a number or name, else none."""
    words = re.findall(r"[^\W\d_]+", before.lower())[-1:]
    if _ASSIGNED.search(before) and words and words[0] in SECRET_WORDS and not text.isdigit():
        return 1
    if text.isdigit() or (words and words[0] in OTHER_WORDS):
        return 0
    return None


def generated_findings(n: int, words: list[str]) -> list[tuple[str, str, str, int]]:
    """Labelled findings (text, before, after, label) from a fixed seed."""
    r = random.Random(31)
    words = words or ["the", "of", "and", "with"]
    text = lambda letters, k: "".join(r.choice(letters) for _ in range(k))
    hexa, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = (
        lambda: text(hexa, r.choice([32, 40, 64])), lambda: text(base, r.randrange(24, 64)), lambda: "AKIA" + text(base[:26] + base[52:], 16),
        lambda: "ghp_" + text(base, 36), lambda: "sk-" + text(base, 48), lambda: text(base + "+/", 40) + r.choice(["", "=", "=="]),
        lambda: text(base + "!&.$%-_", r.randrange(8, 16)), lambda: text(base[:52], r.randrange(16, 40)),
        lambda: ".".join(["eyJ" + text(base, 30), "eyJ" + text(base, 60), text(base + "-_", 43)]),
    )
    other = (
        lambda: text("0123456789", r.randrange(16, 24)), lambda: "-".join(text(hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: "".join(r.choice(words) for _ in range(6))[:40] + text("0123456789", 2), lambda: "/".join(r.choice(words) for _ in range(5)) + "/" + text("0123456789", 3),
        lambda: "_".join(r.choice(words) for _ in range(5)) + "_1", lambda: f"20{text('0123456789', 2)}-01-02-{text('0123456789', 8)}", lambda: "x" * r.randrange(16, 40) + "1",
        lambda: text(hexa, 40),
    )
    found = []
    for _ in range(n):
        lead = " ".join(r.choice(words) for _ in range(3)) + " "
        if r.random() < 0.5:
            name = r.choice([*SECRET_WORDS, "api_key", "access_token"])
            found.append((r.choice(secret)(), lead + name + r.choice([" = \"", ": ", "=", " = '", ": \""]), r.choice(['"', " ", "'", ";"]), 1))
        else:
            name = r.choice([*OTHER_WORDS, *OTHER_WORDS, r.choice(words), r.choice(words)])
            item = r.choice(other)()
            found.append((item, lead + name + r.choice([" ", " ", ": ", "/", " (", "="]), r.choice([" ", ".", ")", ","]), 0))
    return found


def candidates(df: DataFrame, dictionary: Sent, key: str, text: str) -> DataFrame:
    """Rows (id, start, end, secret_sha256, label, features); places are code points, ends exclusive."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        words = dictionary.made(build_dictionary)
        for batch in batches:
            rows: list[tuple] = []
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                for a, b in proposed_spans(t):
                    value, before, after = t[a:b], t[max(0, a - AROUND) : a], t[b : b + AROUND]
                    sha = hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((name, a, b, sha, label_rule(value, before), features(value, before, after, words)))
            yield [list(c) for c in zip(*rows)] if rows else [[] for _ in range(6)]

    docs = df.select(F.col(f"`{key}`").cast("string"), *string_type(df, [text]))
    schema = 'id string, start bigint, end bigint, secret_sha256 string, label int, features array<double>'
    return map_text(docs, run, schema).withColumn("id", F.col("id").cast(df.schema[key].dataType))


def corpus_words(df: DataFrame, text: str) -> list[str]:
    """The most frequent words of the corpus of four letters or more, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    counts.update(t.lower().split())
            if len(counts) > 200_000:
                yield [list(counts), list(counts.values())]
                counts.clear()
        yield [list(counts), list(counts.values())]

    words = map_text(df.select(*string_type(df, [text])), run, "word string, n bigint")
    words = words.where(F.col("word").rlike("^[a-z]{4,15}$")).groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in words.orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).collect()]


def train(found: DataFrame, words: list[str]) -> RandomForestClassificationModel:
    """The forest on labelled findings: plain ones of the corpus, and generated ones."""
    spark = found.sparkSession
    dictionary = build_dictionary(words)
    made = [(features(t, b, a, dictionary), y) for t, b, a, y in generated_findings(GENERATED_FINDINGS, words)]
    schema = "features array<double>, label int"
    corpus = found.where("label IS NOT NULL").select("secret_sha256", "features", "label").dropDuplicates(["secret_sha256"])
    corpus = corpus.orderBy("secret_sha256").limit(CORPUS_FINDINGS).select("features", "label")
    rows = materialize(corpus.union(spark.createDataFrame(made, schema)), "findings")
    data = rows.select(array_to_vector("features").alias("x"), F.col("label").cast("double"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(data)


def secrets(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (key, start, end, secret_sha256, score, secret), one for each candidate.

    A null or empty text has no candidates; repeated rows give repeated findings.
    A candidate of any length is read whole. The secret itself is not returned.
    """
    spark = prepare(df.sparkSession)
    words = corpus_words(df, text)
    found = materialize(candidates(df, Sent(spark, words), key, text), "candidates")
    model = train(found, words)
    scored = model.transform(found.withColumn("x", array_to_vector("features")))
    score = F.round(vector_to_array("probability")[1], 9)
    return scored.select(
        F.col("id").alias(key), "start", "end", "secret_sha256", score.alias("score"), (score >= threshold).alias("secret")
    )
