"""Mixing: targets, exact totals, permutations and the rows that come out."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint, name string, words int"


def corpus(seed: int, docs: int = 120) -> list[tuple]:
    draw = random.Random(seed)
    names = ["b", "a", "é", "Z", None, "\U0001f600", "￿"]
    rows = []
    for i in range(docs):
        source = draw.choices(names, [40, 5, 5, 5, 3, 1, 1])[0]
        text = draw.choice([" ", "\n"]).join(f"d{i}w{j}" for j in range(draw.choice([0, 1, 7, 50, 300])))
        rows.append((i, text, source, len(text), "n", 1))
    return rows + [(500, None, "a", None, None, None), (501, "", "empty", 0, "n", 1), rows[5], rows[5],
                   (None, "no id here", "b", None, None, None)]


def plain_targets(rows: list[tuple]) -> dict:
    """Raise a common level until every word is dealt: cap, then reshare, one source at a time."""
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    names = sorted(sizes, key=lambda x: (x is None, x))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[n] for n in capped)
        every = sum(weight[n] for n in names if n not in capped)
        share = {n: 3 * sizes[n] if n in capped else left * Fraction(weight[n], every) for n in names}
        over = [n for n in names if share[n] > 3 * sizes[n]]
        if not over:
            return share
        capped |= set(over)


@pytest.mark.parametrize(("seed", "block", "slots"), [(1, 16, 10), (2, 64, 1000), (3, 1, 7)])
def test_counts(spark, seed, block, slots):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = M.mix_counts(docs, block_words=block, shard_slots=slots).collect()
    want = plain_targets(rows)
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r[0], len((r[1] or "").split())) for r in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    source = {r[0]: r[2] for r in rows}
    taken = defaultdict(int)
    for r in found:
        taken[source[r.doc_id]] += r.taken
        assert r.target == pytest.approx(float(want[source[r.doc_id]]))
    for name, target in want.items():
        assert abs(taken[name] - target) <= 0.5
    again = M.mix_counts(docs, block_words=block, shard_slots=slots).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_permutations():
    for size in (1, 2, 3, 5, 64, 1000, 4097):
        index = np.arange(size)
        for key in (1, -5):
            got = M.permuted(index, np.full(size, size), np.full(size, key))
            assert sorted(got) == list(range(size))
    a, b = (M.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, k)) for k in (1, 2))
    assert (a != b).mean() > 0.9


def test_draws_cover_every_slot_once():
    tree = M.SlotTree([100, 0, 7, 1], 10, 3)
    drawn = [run for number in range(tree.shards) for run in tree.shard(number)]
    for source, slots in enumerate([100, 0, 7, 1]):
        own = [(first, n) for _, s, first, n in drawn if s == source]
        assert [f for f, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])
        assert sum(n for _, n in own) == slots
    per_shard = Counter()
    for shard, _, _, n in drawn:
        per_shard[shard] += n
    assert [per_shard[i] for i in range(11)] == [10] * 10 + [8]


def test_any_task_draws_a_shard_alike(monkeypatch):
    """Shards follow from the seed alone, in any order and with no split kept."""
    slots = [5_000, 300, 20_000, 1]
    tree = M.SlotTree(slots, 64, 9)
    want = {n: tree.shard(n) for n in range(tree.shards)}
    monkeypatch.setattr(M, "KEPT_COUNTS", 8)
    other = M.SlotTree(slots, 64, 9)
    for n in random.Random(1).sample(range(tree.shards), 60):
        assert other.shard(n) == want[n]
    assert any(M.SlotTree(slots, 64, 10).shard(n) != want[n] for n in range(9))
    # Shards are alike: each holds about its share of every large source.
    for source in (0, 2):
        own = [sum(n for _, s, _, n in want[k] if s == source) for k in range(tree.shards - 1)]
        share = 64 * slots[source] / sum(slots)
        assert abs(np.mean(own) - share) < 1 and 1 < np.std(own) < 3 * share**0.5


def test_a_million_shards_need_no_list():
    tree = M.SlotTree([7 * 10**9, 10**9], 8192, 1)
    assert tree.shards == 976_563
    numbers = range(0, tree.shards - 1, 9973)
    (batch,) = M.shard_batches([pa.record_batch([pa.array(numbers)], ["id"])], tree)
    rows = batch.to_pylist()
    assert {r["shard"] for r in rows} == set(numbers)
    assert all(abs(r["n"] - (7168 if r["_source"] == 0 else 1024)) < 300 for r in rows)
    assert len(tree.known) < 3000


def test_columns_may_have_any_names(spark):
    names = ["_row", "_size", "_name", "_pieces", "_own", "_source", "_text", "_words", "shard", "block", "at", "slot"]
    rows = [(i, "a b c", "s", *(k for k, _ in enumerate(names))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{n} int" for n in names))
    mixed = M.mix_documents(docs, block_words=4)
    assert mixed.columns == docs.columns
    assert Counter(map(tuple, mixed.collect())) == Counter(rows)
    assert sum(r.taken for r in M.mix_counts(docs, block_words=4).collect()) == 15


def test_documents_hold_the_words_that_are_taken(spark):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    counts = Counter()
    for r in M.mix_counts(docs, block_words=16).collect():
        counts[r.doc_id] += r.taken
    mixed = M.mix_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    texts, got = {r[0]: r for r in rows}, Counter()
    for r in mixed.collect():
        original = texts[r.doc_id]
        words = r.text.split()
        got[r.doc_id] += len(words)
        held = Counter(original[1].split())
        assert set(words) <= set(held) and len(words) == len(set(words))
        assert words == [w for w in original[1].split() if w in set(words)]
        assert r.text == original[1] or len(words) < len(held)
        assert r.n_chars == len(r.text) and (r.source, r.name, r.words) == (original[2], *original[4:])
    assert +got == +counts


def test_no_rows_and_no_words(spark):
    assert M.mix_counts(spark.createDataFrame([], SCHEMA)).collect() == []
    blank = spark.createDataFrame([(1, " ", "a", 1, "n", 1), (2, None, None, 0, "n", 1)], SCHEMA)
    assert sorted(tuple(r) for r in M.mix_counts(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mix_documents(blank).collect() == []
