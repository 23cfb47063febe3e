"""Personal data: labelers vote on spans, EM weighs them, a classifier decides.

Candidates are found in every text by generous patterns. Six labelers, by form, checksum,
gazetteer, context words, boundaries and placeholders, each vote yes, no or nothing on each
candidate. What a candidate looks like is one of at most a few thousand patterns, so one scan
counts all candidates of all texts by pattern, summed by Spark. Expectation-maximisation over the
counts estimates how reliable each labeler is and how likely each pattern is personal data; with
these as soft labels a logistic regression over the span's features is trained. A second scan
applies it. Spans of the strict forms are always kept; the classifier adds spans of looser forms.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import by_value

by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Looser forms; every repetition is bounded, so a search is linear in the text.
SPELT = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,4}"
)
IPV6 = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
ANY = re.compile(r"[0-9@]|[(\[ ]dot[)\] ]|:")

# Words that speak for a kind, and words that speak against any.
FOR = {
    "email": ("mail", "contact", "write", "reach", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "address", "client", "from", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon", "llama", "appel"),
}
AGAINST = ("version", "v.", "isbn", "issn", "order", "section", "id", "no.", "serial", "page", "$")
# Endings of host names, first digits of cards, country codes, reserved networks.
ENDINGS = frozenset("com org net edu gov info io de fr es uk eu ch at it nl us ca".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "30", "36", "38")
COUNTRIES = ("1", "33", "34", "39", "41", "43", "44", "49", "52", "54", "55", "81", "86", "91")
RESERVED = ("0.", "10.", "127.", "192.168.", "169.254.", "255.")
WORDS_BEFORE = 32
ROUNDS, LEAST = 60, 0.9


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    form: str


# ---- spans ----------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def strict_spans(text: str) -> list[Span]:
    found = [Span(a, b, "email", "strict") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            found.append(Span(*m.span(), "ip", "strict"))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 40 and 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            found.append(Span(*m.span(), "card", "strict"))
    for m in PHONE.finditer(text):
        if 10 <= len(only_digits(m[0])) <= 15:
            found.append(Span(*m.span(), "phone", "strict"))
    return found


def loose_spans(text: str, strict: list[Span]) -> list[Span]:
    """Further candidates, none overlapping a strict span or an earlier candidate."""
    found = [Span(*m.span(), "email", "spelt") for m in SPELT.finditer(text)] if "dot" in text else []
    if ":" in text:
        found += [Span(*m.span(), "ip", "long") for m in IPV6.finditer(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() < 40 and 13 <= len(only_digits(m[0])) <= 19:
            found.append(Span(*m.span(), "card", "unchecked"))
    found += [Span(*m.span(), "phone", "local") for m in LOCAL_PHONE.finditer(text)]
    out, taken = [], sorted((s.start, s.end) for s in strict)
    at, end = 0, 0
    for span in sorted(found, key=lambda s: (s.start, -s.end)):
        while at < len(taken) and taken[at][0] < span.end:
            end = max(end, taken[at][1])
            at += 1
        if span.start >= end:
            out.append(span)
            end = span.end
    return out


def _glued(character: str) -> str:
    return "letter" if character.isalnum() else "mark" if character and not character.isspace() else "open"


def pattern(text: str, span: Span) -> tuple[str, ...]:
    """What labelers and classifier see of a span."""
    inside = text[span.start : span.end]
    digits = only_digits(inside)
    before = text[max(0, span.start - WORDS_BEFORE) : span.start].lower()
    words = before.replace(":", " ").split()[-3:]
    if any(w.startswith(FOR[span.kind]) for w in words):
        context = "for"
    else:
        context = "against" if any(w.startswith(AGAINST) for w in words) else "none"
    if span.kind == "email":
        check, known = "none", "yes" if re.split(r"[. )\]]", inside.lower())[-1] in ENDINGS else "none"
    elif span.kind == "ip":
        check, known = "none", "no" if inside.startswith(RESERVED) else "none"
    elif span.kind == "card":
        check = "yes" if luhn(digits) else "no"
        known = "yes" if digits.startswith(ISSUERS) else "no"
    else:
        check = "yes" if 10 <= len(digits) <= 15 else "none"
        known = "yes" if "+" in inside and digits.startswith(COUNTRIES) else "none"
    placeholder = bool(digits) and (len(set(digits)) <= 2 and len(digits) > 6 or digits in "01234567890" * 2)
    return (span.kind, span.form, check, known, context, _glued(text[span.start - 1 : span.start]),
            _glued(text[span.end : span.end + 1]), "placeholder" if placeholder else "own")


SAID = {"yes": 1, "for": 1, "no": -1, "against": -1, "none": 0}


def votes(seen: tuple[str, ...]) -> tuple[int, ...]:
    """Form, checksum, gazetteer, context, boundaries, placeholder: 1 yes, -1 no, 0 nothing."""
    _, form, check, known, context, left, right, digits = seen
    edges = -1 if "letter" in (left, right) else 1 if (left, right) == ("open", "open") else 0
    return ({"strict": 1, "unchecked": -1}.get(form, 0), SAID[check], SAID[known], SAID[context], edges,
            -1 if digits == "placeholder" else 0)


# ---- learning ---------------------------------------------------------------------


def reliabilities(counts: dict[tuple, int]) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote counts: (pattern posteriors, labelers' vote probabilities by class).

    Classes are told apart by where the majority of votes starts them. The prior of each kind is
    its own; one candidate is added to each outcome, so that no probability is 0.
    """
    seen = list(counts)
    n = np.array([counts[s] for s in seen], float)
    said = np.array([votes(s) for s in seen]) + 1
    kind = np.array([KINDS.index(s[0]) for s in seen])
    post = 1 / (1 + np.exp(-1.5 * (said - 1).sum(axis=1)))
    table = np.zeros((2, said.shape[1], 3))
    for _ in range(ROUNDS):
        for label, weight in enumerate((n * (1 - post), n * post)):
            for labeler in range(said.shape[1]):
                total = np.bincount(said[:, labeler], weight, 3) + 1
                table[label, labeler] = total / total.sum()
        prior = np.array([
            ((n * post)[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(KINDS))
        ])
        logs = np.log(table)[:, np.arange(said.shape[1]), said].sum(axis=2)
        odds = logs[1] - logs[0] + np.log(prior / (1 - prior))[kind]
        post = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return post, table


def span_features(seen: tuple[str, ...]) -> list[str]:
    kind, form, check, known, context, left, right, digits = seen
    return ["", kind, f"{kind} {form}", f"{kind} {check}", f"{kind} {known}", f"context {context}",
            f"left {left}", f"right {right}", digits]


def train(counts: dict[tuple, int], rounds: int = 300) -> dict[tuple, float]:
    """A probability for each pattern, from a logistic regression on the EM's soft labels."""
    if not counts:
        return {}
    seen = list(counts)
    soft, _ = reliabilities(counts)
    names = sorted({f for s in seen for f in span_features(s)})
    x = np.zeros((len(seen), len(names)))
    for row, s in enumerate(seen):
        x[row, [names.index(f) for f in span_features(s)]] = 1
    n = np.array([counts[s] for s in seen], float)
    w = np.zeros(len(names))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (soft - p)) - 1e-2 * w
        curve = (x.T * (n * p * (1 - p))) @ x + 1e-2 * np.eye(len(names))
        step = np.linalg.solve(curve + 1e-6 * np.eye(len(names)), slope)
        w += step * min(1, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return dict(zip(seen, p.tolist(), strict=True))


# ---- scans --------------------------------------------------------------------------


def count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for value in batch.column("text"):
            text = value.as_py() or ""
            if ANY.search(text):
                strict = strict_spans(text)
                counts.update(pattern(text, s) for s in [*strict, *loose_spans(text, strict)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(["|".join(p) for p in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["pattern", "n"]
        )


def joined(spans: list[Span]) -> str:
    spans = sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def label(batches: Iterator[pa.RecordBatch], model: dict[tuple, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in range(6)]
        for value in batch.column("text"):
            text = value.as_py() or ""
            strict = strict_spans(text) if ANY.search(text) else []
            more = []
            if strict or ANY.search(text):
                more = [s for s in loose_spans(text, strict)
                        if model.get(pattern(text, s), 0.0) >= LEAST]
            for place, kind in enumerate(KINDS):
                columns[place].append(sum(s.kind == kind for s in strict))
            columns[4].append(hashlib.sha256(joined(strict).encode()).hexdigest())
            columns[5].append(joined([*strict, *more]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]],
             *[pa.array(c, pa.string()) for c in columns[4:]]],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): strict spans counted and hashed, and all spans.

    (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); spans are kind:start:end in code
    points, end exclusive, by start and then kind. Counts and base_sha256 are of the strict forms.

    Defined cases: NULL and empty texts have no spans. Rows are judged one by one, so equal rows
    give equal rows; a NULL doc_id is kept. Without any candidate nothing is trained, and without
    rows there are none. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = texts.select("text").mapInArrow(count_patterns, "pattern string, n bigint")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    model = train({tuple(r["pattern"].split("|")): r["n"] for r in rows})
    schema = ", ".join(["doc_id bigint", *[f"n_{k} bigint" for k in KINDS]])
    return texts.mapInArrow(
        lambda it: label(it, model), f"{schema}, base_sha256 string, spans string"
    )
