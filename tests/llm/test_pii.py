"""Personal data: strict spans against plain patterns, EM against known reliabilities."""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pytest

from starmart.llm import pii as P

SCHEMA = "doc_id bigint, text string, spans int, n_email string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(number: str) -> bool:
    table = {c: int(c) * 2 if int(c) < 5 else int(c) * 2 - 9 for c in "0123456789"}
    return (sum(int(c) for c in number[::-1][::2]) + sum(table[c] for c in number[::-1][1::2])) % 10 == 0


def brute(text: str) -> list[tuple[int, int, str]]:
    out = []
    for kind, plain in PLAIN.items():
        for m in re.finditer(plain, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and checksum(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def texts(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    bits = ["a.b@c.d", "x@y", "@", "a@b.c@d.e", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+49 30 1234567", "+1", "+", "é\U0001f600",
            "00000000000000", "call 555-123-4567", "me at home dot org", "٣٤٥", " ", "\n", ".", "-", "12", "0001.002.03.4"]
    out: list[str | None] = ["".join(draw.choices(bits, k=draw.randint(0, 12))) for _ in range(150)]
    out += ["".join(draw.choices("0123456789.+- @a()", k=draw.randint(0, 60))) for _ in range(300)]
    return out + [None, "", "1" * 50_000, "a" * 50_000 + "@", "1." * 20_000, "+1" + "(" * 20_000, "a@" * 10_000]


@pytest.mark.parametrize("seed", [1, 2])
def test_strict_spans_equal_plain_patterns(spark, seed):
    rows = [(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts(seed))]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want, got = [], []
    for doc, text, *_ in rows:
        spans = brute(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        want.append((str(doc), *[sum(s[2] == k for s in spans) for k in PLAIN], hashlib.sha256(joined.encode()).hexdigest()))
    for r in P.find_personal_data(docs).collect():
        got.append((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
        every = [s for s in r.spans.split(",") if s]
        assert len(every) >= sum(r[1:5])
    assert sorted(got) == sorted(want)


def test_em_finds_the_reliable_labelers():
    random_ = np.random.default_rng(5)
    counts: dict = {}
    for _ in range(20_000):
        real = random_.random() < 0.4
        right = lambda p: real if random_.random() < p else not real
        seen = ("card", "strict" if right(0.9) else "unchecked", "yes" if right(0.95) else "no",
                "yes" if right(0.55) else "no", "for" if right(0.8) else "against", "open", "open", "own")
        counts[seen] = counts.get(seen, 0) + 1
    post, table = P.reliabilities(counts)
    yes = table[1, :4, 2] / (table[1, :4, 0] + table[1, :4, 2])
    assert yes == pytest.approx([0.9, 0.95, 0.55, 0.8], abs=0.05)
    assert (np.array(list(counts.values())) * post).sum() / 20_000 == pytest.approx(0.4, abs=0.05)


def test_classifier_adds_spans_in_context_and_leaves_numbers_alone(spark):
    draw = random.Random(3)
    number = lambda k: "".join(draw.choices(string.digits, k=k))
    rows = [(i, f"call +1 {number(3)} {number(3)} {number(4)} now", 1, "") for i in range(200)]
    rows += [(1000 + i, f"phone 030-{number(3)}-{number(4)} please", 1, "") for i in range(50)]
    rows += [(2000 + i, f"order 4{number(14)}x version {number(2)}.{number(2)}", 1, "") for i in range(100)]
    found = {r.doc_id: r.spans for r in P.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[1000 + i] for i in range(50))
    assert sum(bool(found[2000 + i]) for i in range(100)) <= 15


def test_no_rows_and_no_candidates(spark):
    assert P.find_personal_data(spark.createDataFrame([], SCHEMA)).collect() == []
    row = P.find_personal_data(spark.createDataFrame([(1, "plain words", 1, "")], SCHEMA)).first()
    assert (row.spans, row.base_sha256) == ("", hashlib.sha256(b"").hexdigest())
