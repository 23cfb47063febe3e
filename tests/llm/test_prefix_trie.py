"""The trie of conversations, against a dictionary of all beginnings."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from starmart.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int"


def turn_key(role, text) -> bytes:
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())} {role} {text}".encode()).digest()


def brute(rows: list[tuple]) -> Counter:
    talks = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, turn_key(role, text), (role or "", text or "")))
    talks = {c: [t[3] for t in sorted(v, key=lambda t: t[:3])] for c, v in talks.items()}
    members, sizes, ends = defaultdict(set), {(): 0}, defaultdict(list)
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path, ids = talks.get(base, [])[:h] + own[h:], ()
        members[()].add(c)
        known = {}
        for turn in path:
            ids = (ids, turn)  # nested, so that long paths share their beginnings
            ids = known.setdefault(ids, hash_of(ids))
            members[ids].add(c)
            sizes[ids] = len(turn[1].encode())
        ends[ids].append(c)
    parent, children = PARENTS, defaultdict(list)
    nodes = sorted(members, key=lambda i: -DEPTHS.get(i, 0))
    for i in nodes:
        if i != ():
            children[parent[i]].append(i)
    leaves, saved, out = {}, {}, Counter()
    for i in nodes:
        leaves[i] = sum(leaves[c] for c in children[i]) or 1
        saved[i] = sum(saved[c] for c in children[i]) + (len(members[i]) - 1) * sizes[i]
    for i in nodes:
        above = min(members[parent[i]]) if i != () else None
        done = hashlib.sha256(",".join(map(str, sorted(ends.get(i, [])))).encode()).hexdigest()
        out[min(members[i]), DEPTHS.get(i, 0), above, len(members[i]), len(children[i]), leaves[i], saved[i], done] += 1
    return out


PARENTS: dict = {}
DEPTHS: dict = {}


def hash_of(ids: tuple) -> str:
    before, turn = ids
    own = hashlib.sha256(f"{before}|{len(turn[0])}|{turn[0]}|{turn[1]}".encode()).hexdigest()
    PARENTS[own], DEPTHS[own] = before, DEPTHS.get(before, 0) + 1
    return own


def result(spark, rows, shards=None, parts=4) -> Counter:
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return Counter(map(tuple, T.trie_nodes(table, shards).collect()))


def talk(draw, conv: int, n: int, words: int) -> list[tuple]:
    return [(conv, t, draw.choice(["user", "assistant"]), draw.choice(["", "é", "yes", "no", "a b"][:words]), "k", 1)
            for t in range(n)]


def nasty(seed: int, most: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for conv in [*range(-12, 40), *draw.sample(range(40, 500), 40)]:
        if draw.random() < 0.85:
            rows += talk(draw, conv, draw.randint(1, most), draw.randint(1, 5))
    rows += [(7, None, None, None, None, None), (7, None, "", "", "x", 2), (8, 3, "u", "t", "", 0), (8, 3, "u", "t", "", 0),
             (8, 3, "u", "s", "", 0), (None, 1, "u", "lost", "", 0), (11, 1, "user", None, "", 0), (11, 1, None, "user", "", 0)]
    return rows


@pytest.mark.parametrize(("seed", "most", "shards"), [(1, 6, None), (2, 12, 60), (3, 12, 1)])
def test_equals_all_beginnings(spark, seed, most, shards):
    rows = nasty(seed, most)
    assert result(spark, rows, shards) == brute(rows)


@pytest.mark.parametrize(("segment", "shards"), [(2, 24), (3, 1), (4, 200)])
def test_segments_change_nothing(spark, segment, shards, monkeypatch):
    monkeypatch.setattr(T, "SEGMENT", segment)
    monkeypatch.setattr(T, "SEGMENT_BLOCK", 2)
    monkeypatch.setattr(T, "TURN_BLOCK", 3)
    rows = nasty(segment, 16)
    assert result(spark, rows, shards) == brute(rows)


def test_long_conversations(spark):
    """Thousands of turns, twice, one going on where the other ends, and one that leaves them midway."""
    one = [(i % 7, str(i % 11)) for i in range(2000)]
    rows = []
    for conv, path in ((5000, one), (5005, one[:640]), (5010, one[:64]), (5015, one[:1000] + [(9, "away")] * 70), (5020, one)):
        rows += [(conv, t, str(r), x, "", 0) for t, (r, x) in enumerate(path)]
    assert result(spark, rows, 40) == brute(rows)


def test_hot_path(spark, monkeypatch):
    """Most conversations are equal: their ids come from many shards, in chunks."""
    monkeypatch.setattr(T, "CHUNK_BYTES", 40)
    rows = [(5 * c, t, "user", f"same {t}", "", 0) for c in range(400) for t in range(3)]
    rows += [(5 * c + 2001, 0, "user", f"other {c % 7}", "", 0) for c in range(100)]
    assert result(spark, rows, 64, 8) == brute(rows)


def test_nothing_and_one(spark):
    assert result(spark, []) == Counter()
    assert result(spark, [(None, 1, "u", "t", "", 0)]) == Counter()
    for conv in (0, 1, 2, 3):
        rows = [(conv, 0, "u", "w " * 100_000, "", 0)]
        assert result(spark, rows) == brute(rows)
