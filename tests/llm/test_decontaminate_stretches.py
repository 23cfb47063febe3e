"""Passages whose best-scoring stretch is shorter than the length asked for."""

from __future__ import annotations

import itertools
import random

import pytest

from tests.llm.test_decontaminate import brute, result


def test_every_pair_of_substitutions_in_thirteen_words_is_found(spark):
    own, docs = [f"q{i}" for i in range(13)], []
    for n, gone in enumerate(itertools.combinations(range(13), 2)):
        text = [f"x{i}" if i in gone else w for i, w in enumerate(own)]
        docs.append((n, " ".join(["before", *text, "after"]), 1, "s"))
    docs.append((99, " ".join(["x", *own[1:6], "y", *own[7:12], "z"]), 1, "s"))
    assert result(spark, docs, [(5, " ".join(own), 1)]) == {
        (n, 5): (1, 0, 13, 11, True) for n in range(78)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_stretches(spark, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(7, 30))), 1) for i in range(12)]
    docs = []
    for i in range(60):
        text = draw.choices(vocabulary, k=draw.randint(0, 40))
        own = draw.choice(items)[1].split()
        for at in draw.sample(range(len(own)), k=min(len(own), draw.randint(0, 5))):
            own[at] = draw.choice(vocabulary)
        at = draw.randint(0, len(text))
        text[at:at] = own
        docs.append((i, " ".join(text), 1, "s"))
    got, want = result(spark, docs, items), brute(docs, items)
    assert {k: v[2:4] for k, v in got.items()} == {k: v[2:4] for k, v in want.items()}
