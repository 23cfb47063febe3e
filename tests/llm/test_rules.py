"""Quality rules: statistics against plain Python, and what is learned."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.llm import rules as R

SCHEMA = "doc_id bigint, text string, n_words string, bad int"


def brute(text: str | None) -> tuple:
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


def texts(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    bits = ["a", "bb", "é\U0001f600", "#", "x|y", "\x85", " "]
    out: list[str | None] = []
    for _ in range(200):
        lines = [" ".join(draw.choices(bits, k=draw.randint(0, 9))) for _ in range(draw.randint(0, 6))]
        out.append(draw.choice(["\n", " \n", "\r\n", "\t"]).join(lines + lines[:2]))
    return out + [None, "", " \n\t\x0b", "one", "a b c d e", "a b c d e f", "z " * 3000, "\n" * 50, " ".join(f"w{i}" for i in range(5000))]


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_equal_plain_python(spark, seed):
    rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts(seed))]
    rows.append(rows[4])
    found = R.judge(spark.createDataFrame(rows, SCHEMA), [])
    want = sorted((str(r[0]), *(b := brute(r[1])), not b[-1], "None") for r in rows)
    assert sorted((str(r[0]), *r[1:-1], str(r[-1])) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def page(draw: random.Random, bad: int) -> str:
    words = [f"{draw.choice('abcdefgh')}{draw.choice('aeiou')}{draw.randint(0, 99)}n" for _ in range(draw.randint(20, 90))]
    if bad == 1:
        words = [w + draw.choice(["###", "$$$"]) for w in words]
    elif bad == 2:
        words = [w.upper() for w in words]
    return " ".join(words)


def test_learned_list_separates_held_out_texts(spark):
    draw = random.Random(7)
    kinds = [draw.choice([0, 0, 0, 1, 2]) for _ in range(900)]
    rows = [(i, page(draw, k), "x", 1) for i, k in enumerate(kinds)]
    labels = [(i, int(k == 0)) for i, k in enumerate(kinds) if i < 600]
    labels += [(0, 1 - labels[0][1]), (None, 0), (5000, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    rules = R.learn(R.labelled_statistics(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")))
    assert 1 <= len(rules) <= R.MOST_RULES
    judged = {r.doc_id: r for r in R.judge(docs, rules).collect()}
    held = [i for i in range(600, 900) if not judged[i].base_failed]
    assert sum(judged[i].kept == (kinds[i] == 0) for i in held) >= 0.98 * len(held)
    assert all((r.rule is None) == r.kept for r in judged.values() if not r.base_failed)


def test_order_of_rules(spark):
    high, low = R.Condition("n_words", True, 5.0), R.Condition("n_words", False, 9.0)
    rows = spark.createDataFrame([(float(i),) for i in (1, 5, 8, 9)], "n_words double")
    got = rows.select(R.decision([(high, low), (high,)])).collect()
    assert [r[0] for r in got] == [None, 1, 1, 2] and str(high) == "n_words >= 5"


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, quality int")
    assert R.learn(R.labelled_statistics(empty, labels)) == []
    docs = spark.createDataFrame([(1, "only one label here", "x", 1)], SCHEMA)
    assert R.learn(R.labelled_statistics(docs, labels)) == []
    assert R.judge(empty, []).collect() == [] and R.judge(docs, []).first().kept is False
