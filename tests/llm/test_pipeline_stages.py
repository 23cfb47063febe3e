"""The corpus pipeline on a small corpus, stage by stage against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from starmart.llm.jaccard import drop_near_copies
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_jaccard import brute as components
from tests.llm.test_mixing import plain_targets

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('corpus')}"
    draw = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lo", "mir", "tan", "s")]
    items = [(i, " ".join(draw.choices(vocabulary, k=25))) for i in range(4)]
    rows, labels = [], []
    for i in range(260):
        words = draw.choices(vocabulary, k=draw.randint(30, 70))
        good = draw.random() < 0.8
        if not good:
            words = [w.upper() + "!!" for w in words]
        elif rows and draw.random() < 0.2:
            words = draw.choice(rows)[1].split()
            words[0] = "other"
        elif draw.random() < 0.1:
            words[10:10] = draw.choice(items)[1].split()
        rows.append((i, " ".join(words), "en", draw.choice("aab"), 0, 9, "s"))
        if i % 2:
            labels.append((i, int(not rows[-1][1].split()[-1].isupper() and "!!" not in rows[-1][1]), 0))
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "a", 0, 1, "s"), rows[3]]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_every_stage_does_its_work(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{folder}/stage-{number}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        seen.append([tuple(r) for r in docs.collect()])

    good, single, clean, mixed, sharded = seen
    assert all("!!" not in (r[1] or "") for r in good)
    assert Counter(good) <= Counter(rows) and len(good) >= 0.97 * sum("!!" not in (r[1] or "") for r in rows)
    want = {r[0] for r in components([(r[0], r[1]) for r in good]) if r[0] == r[2]}
    assert sorted(r[0] for r in single) == sorted(want) and Counter(single) <= Counter(good)
    caught = {doc for doc, _ in overlaps([r[:2] for r in single], items)}
    assert caught and sorted(r[0] for r in clean) == sorted(want - caught)
    taken = defaultdict(int)
    for r in mixed:
        taken[r[3]] += len(r[1].split())
    for name, target in plain_targets([(r[0], r[1], r[3]) for r in clean]).items():
        assert abs(taken[name] - target) <= 0.5
    assert Counter(r[:5] for r in sharded) == Counter(r[:5] for r in mixed)
    home = defaultdict(set)
    for r in sharded:
        home[r[0]].add(r[5])
    assert all(len(s) == 1 and 0 <= min(s) < 40 for s in home.values())


def test_run_gives_what_the_stages_give(spark, tables):
    folder, rows, _ = tables
    out = corpus_pipeline.run(spark, folder)
    ids = {r[0] for r in rows}
    found = out.collect()
    assert found and {r.doc_id for r in found} <= ids


def test_each_row_is_judged_by_its_own_text(spark):
    """Repeated and missing ids: copies go whatever their id, other texts stay."""
    text = " ".join(f"w{i}" for i in range(20))
    other = " ".join(f"v{i}" for i in range(20))
    rows = [(1, text, "a"), (1, text, "b"), (2, text, "c"), (None, text, "d"), (3, "else", "e"), (3, "else", "f"),
            (2, other, "g"), (None, other + " x", "h"), (None, "alone here", "i"), (4, "", "j"), (4, "", "k"), (None, None, "l")]
    left = drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string, _row string"))
    assert left.columns == ["doc_id", "text", "_row"]
    kept = Counter((r.doc_id, r.text) for r in left.collect())
    assert kept == Counter([(1, text), (3, "else"), (2, other), (None, "alone here"), (4, ""), (4, ""), (None, None)])
