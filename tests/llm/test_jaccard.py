"""The Jaccard join against comparing every pair of sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from starmart.llm import jaccard
from starmart.llm.components import components

SCHEMA = "doc_id bigint, text string, token string, component_id int"


def brute(rows: list[tuple], n: int = 5) -> list[tuple]:
    def shingles(text: str | None) -> frozenset:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()

    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else r[0]))
    return sorted(out, key=str)


def corpus(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(draw.choices(vocabulary, k=30))
    texts = []
    for _ in range(14):
        base = draw.choices(vocabulary, k=draw.randint(1, 120))
        texts.append(" ".join(base))
        for _ in range(draw.randint(0, 6)):
            near = list(base)
            for _ in range(draw.randint(0, 3)):
                near[draw.randrange(len(near))] = draw.choice(vocabulary)
            texts.append("  ".join(near).upper() if draw.random() < 0.2 else "\n".join(near))
        if draw.random() < 0.5:
            texts.append(passage + " " + " ".join(draw.choices(vocabulary, k=draw.randint(0, 10))))
    texts += [None, "", " \t\n", "one", "ONE", "one two", "é É", "a b c d e", "a b c d e a b c d e"]
    ids = draw.sample(range(1000), len(texts))
    return [(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)]


def result(spark, rows: list[tuple], parts: int = 3) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "PART_TOKENS", 500)
    rows = corpus(seed)
    assert result(spark, rows) == brute(rows)


def test_hot_grams_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_SHARE", 10_000_000)
    rows = [(i, f"{' '.join(f'p{j}' for j in range(40))} tail{i // 2}", "x", 1) for i in range(60)]
    assert result(spark, rows) == brute(rows)


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, "x", 1), (7, text, "x", 1), (7, text, "x", 1), (9, text + " z", "x", 1),
            (None, "alone in the world it is", None, None), (None, None, None, None), (3, "a", "x", 1)]
    assert result(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert result(spark, []) == []


def test_one_very_long_text(spark):
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
    rows = [(1, long, "x", 1), (2, long + " end", "x", 1), (3, "w" * 3_000_000, "x", 1)]
    found = result(spark, rows)
    assert [(r[0], r[2]) for r in found] == [(1, 1), (2, 1), (3, 3)]


def test_components_of_chains_and_stars(spark, tmp_path):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7)]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in "ab"])
    found = components(spark.createDataFrame(links, schema), f"file://{tmp_path}/c").collect()
    assert sorted(map(tuple, found)) == sorted(
        [(i, 100) for i in range(100, 161)] + [(500, 500)] + [(i, 500) for i in range(501, 540)]
    )
