"""Spaced seeds against aligning every text with every item at every shift."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from starmart.llm import decontaminate as D

DOCS, ITEMS = "doc_id bigint, text string, item_id int, seed string", "item_id bigint, text string, doc_id int"


def split(text: str | None) -> list[str]:
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall("[0-9a-z\x80-\U0010ffff]+", low)


def brute(docs: list[tuple], items: list[tuple], least: int = 13, percent: int = 80) -> dict:
    """All stretches of enough words at every shift; of each seeded shift the best, the first of equals."""
    out: dict = {}
    for (doc, text, *_), (item, passage, *_) in itertools.product(docs, items):
        w, v = split(text), split(passage)
        for shift in range(-len(v) + 1, len(w)):
            pairs = [(i, i - shift) for i in range(max(0, shift), min(len(w), shift + len(v)))]
            equal = [w[i] == v[j] for i, j in pairs]
            seeded = any(
                all(equal[at + k] for k, c in enumerate(m) if c == "1")
                for m in D.MASKS for at in range(len(equal) - len(m) + 1)
            )
            short = len(v) < min(map(len, D.MASKS)) and len(equal) == len(v) and all(equal)
            if not seeded and not short:
                continue
            found = [
                (100 * sum(equal[a:b]) - percent * (b - a), -b, -a)
                for a in range(len(equal)) for b in range(a + min(least, len(v)), len(equal) + 1)
            ]
            score, b, a = max(found, default=(-1, 0, 0))
            if score >= 0:
                a, b = -a, -b
                row = (sum(equal[a:b]), b - a, -pairs[a][0], -pairs[a][1], b - a == len(v))
                out[doc, item] = max(out.get((doc, item), row), row)
    return {k: (-v[2], -v[3], v[1], v[0], v[4]) for k, v in out.items()}


def result(spark, docs: list[tuple], items: list[tuple]) -> dict:
    found = D.overlaps(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    return {tuple(r)[:2]: tuple(r)[2:] for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_alignments(spark, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(4, 30))), 1) for i in range(12)]
    docs = []
    for i in range(50):
        text = draw.choices(vocabulary, k=draw.randint(0, 60))
        if draw.random() < 0.7:
            own = draw.choice(items)[1].split()
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary).upper()
            a = draw.randint(0, 3)
            at = draw.randint(0, len(text))
            text[at:at] = own[a:]
        docs.append((i, draw.choice([" ", ", ", "\n"]).join(text), 1, "s"))
    docs += [(90, None, 1, "s"), (91, "", 1, "s"), (92, items[0][1], None, None),
             (92, items[0][1], None, None), (92, items[1][1], 1, "s"), (93, "w " * 400, 1, None)]
    items += [(50, None, 1), (51, "", 1), (52, "one two", None), (53, "w " * 20, 1)]
    got, want = result(spark, docs, items), brute(docs, items)
    assert {k: v[2:4] for k, v in got.items()} == {k: v[2:4] for k, v in want.items()}


def test_items_shorter_than_the_masks(spark):
    """Exact copies of one to six words, in long, hot and too short texts; each place counts once."""
    items = [(k, " ".join(f"q{k}{i}" for i in range(k)), 1) for k in range(1, 7)] + [(9, "Hot", 1), (10, "", 1)]
    docs = [(k, f"a b, {text.upper()} c " * 3, 1, "s") for k, text, _ in items if text]
    docs += [(20, "q60 q61 q62 q63 q64", 1, "s"), (21, "q60 q61 x q63 q64 q65", 1, "s"), (22, "hot " * 5000, 1, "s"),
             (23, "q20", 1, "s"), (24, "q21 q20", 1, "s"), (25, "x q20", 1, "s"), (26, "q21 y", 1, "s"), (27, None, 1, "s")]
    assert result(spark, docs, items) == brute(docs, items)


def test_a_sentence_that_many_items_share(spark):
    """1,000 items with one common sentence: only passages of enough words are found."""
    common = " ".join(f"c{i}" for i in range(8))
    items = [(i, f"{common} " + " ".join(f"i{i}w{j}" for j in range(12)), 1) for i in range(1000)]
    docs = [(k, f"x{k} {common} y{k}", 1, "s") for k in range(20)] + [(99, items[7][1], 1, "s")]
    assert result(spark, docs, items) == {(99, 7): (0, 0, 20, 20, True)}


def test_any_two_substitutions_in_thirteen_words_leave_a_seed():
    for gone in itertools.combinations(range(13), 2):
        equal = np.ones(13, bool)
        equal[list(gone)] = False
        assert any(
            all(equal[at + k] for k, c in enumerate(m) if c == "1")
            for m in D.MASKS for at in range(13 - len(m) + 1)
        ), gone


def test_null_ids_and_empty_tables(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    docs = [(None, "x " + passage, 1, "s"), (1, "nothing here at all", 1, "s")]
    assert list(result(spark, docs, [(None, passage, 1)])) == [(None, None)]
    assert result(spark, [], [(1, passage, 1)]) == {}
    assert result(spark, docs, []) == {}
    left = D.clean(spark.createDataFrame([*docs, (2, passage.upper(), 1, "s")], DOCS),
                   spark.createDataFrame([(1, passage, 1)], ITEMS))
    assert left.columns == ["doc_id", "text", "item_id", "seed"]
    assert [r[0] for r in left.collect()] == [1]


def test_rows_are_judged_by_their_own_text(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    rows = [(1, passage, 1, "a"), (1, "fine", 1, "b"), (None, passage, 2, "c"), (None, "fine too", 2, "d"),
            (2, None, 3, "e"), (2, "", 3, "f"), (1, "fine", 1, "b")]
    left = D.clean(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, passage, 1)], ITEMS))
    assert sorted(r.seed for r in left.collect()) == ["b", "b", "d", "e", "f"]


def test_long_text(spark):
    passage = " ".join(f"q{i}" for i in range(40))
    long = " ".join(f"w{i}" for i in range(300_000))
    found = result(spark, [(1, f"{long} {passage} {long}", 1, "s"), (2, "z" * 3_000_000, 1, "s")], [(5, passage, 1)])
    assert found == {(1, 5): (300_000, 0, 40, 40, True)}
