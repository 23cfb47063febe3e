"""Shared helpers: joins by counted size, numbering, word hashing."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import common, tokens


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_having_gives_the_same_rows_broadcast_or_shuffled(spark, limit, how):
    rows = spark.range(300).selectExpr("if(id % 7 = 0, NULL, id % 50) AS k", "id")
    ids = spark.range(0, 50, 3).selectExpr("id AS k")
    found = common.having(rows, ids, "k", how, limit)
    text = found._jdf.queryExecution().toString()
    assert ("ResolvedHint (strategy=broadcast)" in text or "strategy=broadcast" in text) == (limit > 0)
    keys = set(range(0, 50, 3))
    want = [i for i in range(300) if (i % 7 != 0 and i % 50 in keys) == (how == "left_semi")]
    assert sorted(r.id for r in found.collect()) == want


def test_sums_in_content_order_do_not_depend_on_the_split(spark, tmp_path):
    draw = random.Random(2)
    data = [(draw.choice(["a", "b", None]), draw.choice([None, *range(40)]), draw.randint(1, 9)) for _ in range(600)]
    data += [("a", 7, 5)] * 300
    seen = []
    for parts in (1, 7):
        rows = spark.createDataFrame(data, "g string, id bigint, size bigint").repartition(parts)
        rows = common.numbered(rows, f"file://{tmp_path}/{parts}")
        out = common.content_sums(rows, "g", ["id", "size"], F.col("size"), "at").collect()
        seen.append(sorted((str(r.g), str(r.id), r["size"], r.at) for r in out))
        groups = defaultdict(list)
        for r in out:
            groups[r.g].append((r.at, r["size"]))
        for spans in groups.values():
            end = 0
            for at, size in sorted(spans):
                assert at == end
                end += size
    assert seen[0] == seen[1] and len(seen[0]) == 900


def test_words_are_split_and_hashed_like_plain_python():
    draw = random.Random(1)
    texts = ["".join(draw.choices([" ", "\t", "\x0b", "a", "B", "é", "\x85", "  ", "word"], k=draw.randint(0, 30))) for _ in range(200)]
    texts += [None, "", "x" * 3_000_000, " " * 1000, "　 a"]
    column = pa.array(texts).slice(3)
    found = tokens.words(column)
    plain = [(t or "").encode().split() for t in texts[3:]]
    assert found.counts.tolist() == [len(p) for p in plain]
    hashes: dict = {}
    for word, value in zip([w for p in plain for w in p], found.hashes.tolist(), strict=True):
        assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)
    low = tokens.words(pa.array(["Ab É", "aB É", "ab é"]), lower=True).hashes
    assert low[0] == low[2] == low[4] and low[1] == low[3] != low[5]
    pieces = list(tokens.slices(column, 100))
    assert pieces[0][0] == 0 and pieces[-1][1] == len(column)
    assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False))


def test_window_and_text_hashes_tell_order_and_length():
    found = tokens.words(pa.array(["a b c a b c", "a b c", "c b a", "a b", "", "a b c"]))
    windows = tokens.window_hashes(found.hashes, 3)
    assert windows[0] == windows[3] == windows[6] and len(np.unique(windows[:4])) == 3
    whole = tokens.text_hashes(found, tokens.WINDOW_BASES[0])
    assert whole[1] == whole[5] and len(np.unique(whole[:5])) == 5
