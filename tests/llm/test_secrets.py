"""Secrets: spans against plain patterns, and what the Markov models tell apart."""

from __future__ import annotations

import hashlib
import random
import re
import string

import pytest

from starmart.llm import arrays, secrets as S
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, spans int, _hint string"
PLAIN = {
    "assign": (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def brute(text: str) -> list[tuple]:
    found = [
        (m.start(), m.end(), i, k) for i, (k, (p, g, least)) in enumerate(PLAIN.items())
        for m in re.finditer(p, text) if len(m[g]) >= least
    ]
    return sorted(found)


def texts(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    bits = ["password", "PassWord", "token", "apikey", "API_KEY", "ſecret", "toKen", "'", '"', " ", "  ", ":", "=", "AKIA", "AKIA",
            "A" * 14, "ABC123", "deadbeef", "0123456789abcdef", "é", "\U0001f600", "\n", "abcdefghijkl", "x", "+/=_-.", "secret: token:"]
    out: list[str | None] = ["".join(draw.choices(bits, k=draw.randint(0, 14))) for _ in range(400)]
    return out + [None, "", "token " * 3000, "token=" + "a" * 100_000, ("AKIA" + "B" * 14 + " ") * 3000, "f" * 200_000]


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans_equal_plain_patterns(spark, seed):
    rows = [(i if i % 9 else None, t, 1, "h") for i, t in enumerate(texts(seed))]
    rows.append(rows[5])
    found = S.find_secrets(spark.createDataFrame(rows, SCHEMA), [0.0] * S.SIZE * S.SIZE)
    want = []
    for doc, text, *_ in rows:
        spans = brute(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, b, _, k in spans)
        want.append((str(doc), *[sum(s[3] == k for s in spans) for k in PLAIN], hashlib.sha256(joined.encode()).hexdigest(), joined))
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def strings(draw: random.Random, k: int) -> list[tuple[str, bool]]:
    words = ["get", "user", "name", "from", "table", "index", "write", "the", "page", "default", "handler", "count"]
    plain = ["_".join(draw.choices(words, k=draw.randint(4, 7))) for _ in range(k)]
    noise = ["".join(draw.choices(string.ascii_letters + string.digits, k=draw.randint(22, 50))) for _ in range(k)]
    return [(x, False) for x in plain] + [(x, True) for x in noise]


def test_models_tell_held_out_strings_apart(spark):
    draw = random.Random(4)
    ratios = S.train(spark.createDataFrame(strings(draw, 1500), "value string, is_random boolean"))
    held = [x for x in strings(draw, 200) if len(x[0]) >= S.LEAST_RUN]
    rows = [(i, f"éé say {value} again", 1, "") for i, (value, _) in enumerate(held)]
    rows.append((9999, f"token: {held[-1][0]} {held[-1][0]}", 1, ""))
    found = {r.doc_id: r.spans for r in S.find_secrets(spark.createDataFrame(rows, SCHEMA), ratios).collect()}
    right = sum((found[i] == f"markov:7:{7 + len(v)}") == is_random for i, (v, is_random) in enumerate(held))
    assert right >= 0.98 * len(held)
    size = len(held[-1][0])
    assert found[9999] == f"assign:0:{7 + size},markov:{8 + size}:{8 + 2 * size}"


def test_training_without_rows(spark):
    empty = spark.createDataFrame([], "value string, is_random boolean")
    assert set(S.train(empty)) == {0.0}
    docs = spark.createDataFrame([(1, None, 1, ""), (2, "some words here", 1, "")], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 0), (None, 1)], "doc_id bigint, quality int")
    assert {r.is_random for r in S.samples(docs, labels).collect()} == {True, False}
    assert S.find_secrets(spark.createDataFrame([], SCHEMA), S.train(empty)).collect() == []


def test_running_folds(spark):
    for n in (0, 1, 127, 128, 129, 1000):
        row = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>").alias("v") if n else F.array().cast("array<bigint>").alias("v"))
        got = row.select(arrays.running_total(F.col("v")).alias("r")).first().r
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_time_grows_with_the_text_and_not_with_its_square(spark):
    """Long texts of runs that the model looks at, one after the other."""
    import time

    ratios = S.train(spark.createDataFrame(
        [("x9Kq2LpV7bTn4RzW1cYd", True), ("internal_identifier_name", False)] * 5, "value string, is_random boolean"))
    draw = random.Random(1)

    def seconds(runs: int) -> float:
        text = " ".join("".join(draw.choices("abcdefghijklmnop0123456789QRSTUVWXYZ", k=24)) for _ in range(runs))
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        began = time.perf_counter()
        S.find_secrets(docs, ratios).collect()
        return time.perf_counter() - began

    seconds(100)
    small = min(seconds(10_000) for _ in range(2))
    assert min(seconds(40_000) for _ in range(2)) < 6 * small + 1
