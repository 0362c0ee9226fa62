"""Personal data in texts: fixed patterns, and a semi-Markov CRF for other spellings.

The patterns give the base spans. The field is trained here, on generated regions
in which addresses and numbers of many spellings, and look-alikes such as dates,
versions and numbers with a wrong check sum, stand between words of the corpus.
It reads the regions around digits, @ and written-out "at", and its entities that
do not touch a base span are added.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Sent, prepare, sha_hex, string_type
from shelfwise.llm.semi_crf import KINDS, SemiCrf, luhn

#: Generated regions for training, and words of the corpus that stand in them, at most.
REGIONS, CONTEXT_WORDS = 900, 2_000
#: Characters read on either side of a digit or sign.
AROUND = 48

# The base patterns.
_EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9]|@|[\[(] ?at ?[\])]| at (?=[^\s]+ dot )", re.I)
_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans of a text: leftmost, non-overlapping for each kind, in order."""
    found = []
    at = text.find("@")
    free = 0  # end of the match before
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _EMAIL_END.match(text, at) if start < at else None
        if match:
            found.append(("email", start, match.end()))
        free = match.end() if match else at + 1
        at = text.find("@", free)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Ranges around digits and at-signs, merged where they meet and cut at blanks."""
    first, last = -1, -1
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if first >= 0 and a > last:
            yield first, last
            first = -1
        if first < 0:
            first = a if a == 0 else a + max(0, text[a : m.start()].find(" "))
        last = b
    if first >= 0:
        yield first, last


def find_spans(text: str | None, model: SemiCrf) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base and added spans, of a whole text."""
    if not text or not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    more = []
    for a, b in regions(text):
        more += [(kind, a + i, a + j) for kind, i, j in model.decode(text[a:b])]
    busy = sorted((a, b) for _, a, b in base)
    added, k = [], 0
    reach = 0  # furthest end of the base spans that start before the entity ends
    for kind, a, b in sorted(more, key=lambda s: s[1]):
        while k < len(busy) and busy[k][0] < b:
            reach = max(reach, busy[k][1])
            k += 1
        if a >= reach:
            added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (s[1], _ORDER[s[0]]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end, joined by commas."""
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


class Generator:
    """Labelled regions from a fixed seed."""

    def __init__(self, words: list[str]):
        self.random = random.Random(20)
        self.words = words or ["the", "of", "and"]

    def digits(self, n: int) -> str:
        return "".join(self.random.choice("0123456789") for _ in range(n))

    def email(self) -> str:
        r = self.random
        name = f"{r.choice(self.words)}{r.choice(['', '.' + self.digits(2), '_' + r.choice(self.words), self.digits(2)])}"
        host, tail = r.choice(["mail", "post", "inbox", r.choice(self.words)]) + r.choice(["", self.digits(1)]), r.choice(["com", "org", "net", "de", "fr", "es", "co.uk", "example.com"])
        at, dot = r.choice([("@", ".")] * 4 + [(" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", ".")])
        return f"{name}{at}{host}{dot}{tail.replace('.', dot)}"

    def ip(self) -> str:
        dot = self.random.choice([".", ".", ".", "[.]"])
        return dot.join(str(self.random.randrange(256)) for _ in range(4))

    def card(self, valid: bool = True) -> str:
        r = self.random
        n = r.choice([16, 16, 16, 15])
        body = r.choice("3456") + self.digits(n - 2)
        check = next(c for c in "0123456789" if luhn(body + c))
        text = body + (check if valid else r.choice([c for c in "0123456789" if c != check]))
        sep = r.choice(["", "", " ", "-", "."])
        return sep.join([text[:4], text[4:8], text[8:12], text[12:]] if n == 16 else [text[:4], text[4:10], text[10:]])

    def phone(self) -> str:
        a, b, c = self.random.randrange(200, 999), self.random.randrange(200, 999), self.digits(4)
        land = self.random.choice(["1", "44", "49", "33", "34"])
        return self.random.choice([
            f"+{land} ({a}) {b}-{c}", f"+{land} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
            f"+{land}-{a}-{b}-{c}", f"+{land}{a}{b}{c}", f"00{land} {a} {b} {c}",
        ])

    def other(self) -> str:
        r = self.random
        return r.choice([
            f"{r.randrange(1900, 2100)}-{r.randrange(1, 13):02}-{r.randrange(1, 29):02}", f"{r.randrange(1, 29)}.{r.randrange(1, 13)}.{r.randrange(1900, 2100)}",
            f"{r.randrange(9)}.{r.randrange(20)}.{r.randrange(20)}", f"{r.randrange(256, 999)}.{r.randrange(999)}.{r.randrange(256, 999)}.{r.randrange(999)}",
            f"{r.randrange(10)}.{r.randrange(10)}.{r.randrange(10)}.{r.randrange(10)}.{r.randrange(10)}", self.card(False), self.card(False), self.digits(16),
            self.digits(r.randrange(4, 13)), f"{r.randrange(1, 999)},{self.digits(3)}.{self.digits(2)}", f"{r.randrange(24)}:{self.digits(2)}:{self.digits(2)}",
            "978" + self.digits(10), f"{r.randrange(1900, 2100)}-{r.randrange(1900, 2100)}", f"{r.choice(self.words)}{self.digits(4)}", f"@{r.choice(self.words)}",
            "".join(r.choice("0123456789abcdef") for _ in range(40)), f"{r.randrange(10, 99)} {r.randrange(10, 99)} {r.randrange(10, 99)}",
            f"{r.choice(self.words)} at {r.choice(self.words)}", f"{r.randrange(1, 99)}.{self.digits(6)}", f"{self.digits(5)}-{self.digits(4)}", self.digits(r.randrange(20, 40)),
        ])

    def region(self) -> tuple[str, list[tuple[str, int, int]]]:
        """Words with one to three items, and the entities among these."""
        r = self.random
        text, found = "", []
        for _ in range(r.randrange(1, 4)):
            text += " ".join(r.choice(self.words) for _ in range(r.randrange(1, 5))) + r.choice([" ", " ", " ", ": ", ", ", ' = "'])
            kind = r.choice([*KINDS, "card pair", "other", "other", "other", "other"])
            many = [("card", self.card()), ("card", self.card())] if kind == "card pair" else [(kind, getattr(self, kind)())]
            for i, (name, item) in enumerate(many):
                text += " " * (i > 0)
                if name != "other":
                    found.append((name, len(text), len(text) + len(item)))
                text += item
            text += r.choice([" ", " ", ". ", ", ", '" ', "%%% ", "!! "])
        return text + r.choice(self.words), found


def train(words: list[str]) -> SemiCrf:
    """The field, fitted on generated regions between the given words."""
    generator = Generator(words)
    model = SemiCrf()
    model.fit([generator.region() for _ in range(REGIONS)])
    return model


def context_words(df: DataFrame, text: str) -> list[str]:
    """Words of the first documents by text hash, at most CONTEXT_WORDS: a bounded sample for training."""
    body = F.col(f"`{text}`").cast("string")
    sample = df.select(F.substring(body, 1, 2000).alias("t"), F.xxhash64(body).alias("h")).orderBy("h", "t").limit(40)
    words = sorted({w for r in sample.collect() if r["t"] for w in re.findall(r"[^\W\d_]{2,12}", r["t"].lower())})
    return random.Random(3).sample(words, min(len(words), CONTEXT_WORDS))


FOUND = ("_pii_base", "_pii_spans")


def with_spans(df: DataFrame, text: str = "text", model: SemiCrf | None = None) -> DataFrame:
    """``df`` with its base spans and all spans as strings, in a pass without a shuffle."""
    spark = prepare(df.sparkSession)
    place = df.columns.index(text)
    model = model or train(context_words(df, text))
    sent = Sent(spark, (model.weights, model.moves))
    schema = df.select("*", *(F.lit("").alias(c) for c in FOUND)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SemiCrf(*sent.broadcast.value)
        for batch in batches:
            found = [find_spans(t, field) for t in batch.column(place).cast(pa.string()).to_pylist()]
            more = [pa.array([joined(f[k]) for f in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return df.mapInArrow(run, schema)


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text", model: SemiCrf | None = None) -> DataFrame:
    """Rows (key, n_email, n_ip, n_card, n_phone, base_sha256, spans), one for each row.

    The counts and the hash are of the base spans; ``spans`` has all of them. A
    null or empty text has none. Places are code points, ends exclusive.
    Repeated rows stay; other columns are ignored.
    """
    docs = df.select(F.col(f"`{key}`"), *string_type(df, [text]))
    base, spans = (F.col(c) for c in FOUND)
    counts = [
        F.expr(f"cast(size(filter(split({FOUND[0]}, ','), s -> s LIKE '{kind}:%')) AS bigint)").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return with_spans(docs, text, model).select(
        F.col(f"`{key}`"), *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans")
    )


def redact_text(text: str, spans: str) -> str:
    """A text with its spans replaced by [KIND]; spans that overlap are replaced as one."""
    out, at = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",")):
        start, end = int(a), int(b)
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(df: DataFrame, text: str = "text", length: str | None = "n_chars", model: SemiCrf | None = None) -> DataFrame:
    """``df`` with all spans redacted in ``text``, and ``length`` set anew where the text changed."""
    found = with_spans(df, text, model)
    place, at = df.columns.index(text), len(df.columns) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(place), batch.column(at)
            new = [redact_text(t, s) if s else t for t, s in zip(texts.to_pylist(), spans.to_pylist())]
            columns = [*batch.columns]
            columns[place] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    changed = F.col(FOUND[1]) != ""
    out = found.mapInArrow(run, found.schema)
    if length in df.columns:
        new = F.when(changed, F.length(text)).otherwise(F.col(length)).cast(df.schema[length].dataType)
        out = out.withColumn(length, new)
    return out.drop(*FOUND)
