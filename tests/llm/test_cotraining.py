"""Co-training: accuracy on held-out documents, what is passed on, and empty inputs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from starmart.llm import cotraining as C

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, text_view string"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(seed: int, n: int) -> tuple[list[tuple], list[int]]:
    draw = random.Random(seed)
    rows, good = [], []
    for i in range(n):
        fine = draw.random() < 0.75
        words = [f"{draw.choice(['lo', 'ka', 'mi'])}{draw.choice(['ren', 'tul', 'so'])}{draw.choice('aeiou')}" for _ in range(draw.randint(15, 60))]
        if not fine:
            kind = draw.randint(0, 2)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + "$$" for w in words] if kind == 1 else words[:1] * 40
        width = 12 if fine else draw.choice([3, 12])
        text = "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))
        source = draw.choice(["a", "b"]) if fine or draw.random() < 0.3 else "spam"
        rows.append((i, text, "en", source, len(text), 1, "x"))
        good.append(int(fine))
    return rows, good


def test_held_out_accuracy_and_passing_on(spark):
    rows, good = corpus(3, 900)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, good[i], 0) for i in range(250)] + [(0, 1 - good[0], 0), (None, 1, 0), (7000, 1, 0)], LABELS)
    model = C.train(docs, labels, rounds=2)
    found = {r.doc_id: r for r in C.score(docs, model).collect()}
    held = range(250, 900)
    assert sum(found[i].kept == bool(good[i]) for i in held) >= 0.97 * len(held)
    page = sum((found[i].page_score >= 0.5) == bool(good[i]) for i in held)
    text = sum((found[i].text_score >= 0.5) == bool(good[i]) for i in held)
    assert text >= 0.95 * len(held) and page >= 0.8 * len(held)
    brier = sum((found[i].score - good[i]) ** 2 for i in held) / len(held)
    assert brier < 0.05
    odd = [(None, None, None, None, None, None, None), (5, "", "en", "a", 0, 1, "x"), (5, "", "en", "a", 0, 1, "x"),
           (6, "long " * 200_000, "en", "new", -5, 1, "x")]
    odd_rows = C.score(spark.createDataFrame(odd, SCHEMA), model).collect()
    assert len(odd_rows) == 4 and all(0 <= r.score <= 1 for r in odd_rows)
    assert C.score(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_surest_documents_are_shared_by_label(spark):
    rows = [(i, p) for i, p in enumerate([0.99, 0.96, 0.5, 0.04, 0.01, 0.97])]
    got = {(r.doc_id, r._label) for r in C._surest(spark.createDataFrame(rows, "doc_id bigint, p double"), 0.75).collect()}
    assert got == {(0, 1.0), (1, 1.0), (5, 1.0), (3, 0.0), (4, 0.0)}


def test_labels_that_depend_on_vocabulary_alone(spark):
    """Good and bad texts have the same shapes, lengths and metadata, and differ in a third of their words."""
    draw = random.Random(8)
    common, good_words, bad_words = (["".join(draw.choices("abcdefghij", k=6)) for _ in range(n)] for n in (300, 60, 60))
    rows, good = [], []
    for i in range(800):
        good.append(draw.random() < 0.6)
        own = good_words if good[-1] else bad_words
        text = " ".join(draw.choice(own if draw.random() < 0.33 else common) for _ in range(40))
        rows.append((i, text, "en", draw.choice("ab"), len(text), 1, "x"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = C.train(docs, spark.createDataFrame([(i, int(good[i]), 0) for i in range(500)], LABELS))
    found = {r.doc_id: r.kept for r in C.score(docs, model).collect()}
    assert sum(found[i] == good[i] for i in range(500, 800)) >= 0.95 * 300


def test_the_page_view_sees_nothing_of_the_text(spark):
    rows = [(1, "short", "en", "a", 10, 1, "x"), (2, "quite another\ntext\n\nwith lines", "en", "a", 10, 1, "x")]
    page = [r.page_features for r in C.with_features(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert page[0] == page[1]


def test_repeated_ids_train_alike_whatever_their_order(spark):
    """Rows that share an id but differ: the same one is learned from, in any order."""
    rows, good = corpus(6, 240)
    rows += [(i, "other text " + str(i), "de", "z", 3, 1, "x") for i in range(60)] + rows[:30]
    labels = spark.createDataFrame([(i, good[i], 0) for i in range(150)], LABELS)
    scores = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        model = C.train(docs, labels, rounds=1)
        scores.append(sorted((r.doc_id, round(r.score, 6)) for r in C.score(docs, model).collect()))
    assert scores[0] == scores[1]


def test_exchange_equals_choosing_among_all(spark):
    """What a round passes on, against sorting every unlabelled document by its chance."""
    rows, good = corpus(7, 400)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    known = spark.createDataFrame([(i, float(good[i])) for i in range(100)], "doc_id bigint, _label double")
    model = C.train(docs, spark.createDataFrame([(i, good[i], 0) for i in range(100)], LABELS), rounds=0)
    pool = C.with_features(docs.select("doc_id", "text", "source", "lang", "n_chars", F.xxhash64("text").alias("_row")))
    scored = C._sure(pool, model.views, known)
    every = {r.doc_id: (r.text_score, r.page_score) for r in C.score(docs, model).collect() if r.doc_id >= 100}
    sure = {i: p for i, p in every.items() if any(x >= C.SURE or x <= 1 - C.SURE for x in p)}
    found = {r.doc_id: (r.text, r.page) for r in scored.collect()}
    assert found.keys() == sure.keys() and all(abs(a - b) < 1e-9 for i in sure for a, b in zip(found[i], sure[i]))
    for at, view in enumerate(("text", "page")):
        chosen = {(r.doc_id, r._label) for r in C._surest(scored.select("doc_id", F.col(view).alias("p")), 0.8).collect()}
        best = sorted((i for i in sure if sure[i][at] >= C.SURE), key=lambda i: (-sure[i][at], i))[: round(400 * 0.8)]
        worst = sorted((i for i in sure if sure[i][at] <= 1 - C.SURE), key=lambda i: (sure[i][at], i))[: round(400 * 0.2)]
        assert chosen == {(i, 1.0) for i in best} | {(i, 0.0) for i in worst}


def test_without_two_labels_all_is_kept(spark):
    rows, _ = corpus(5, 20)
    docs = spark.createDataFrame(rows, SCHEMA)
    for labels in ([], [(i, 1, 0) for i in range(20)], [(900, 0, 0)]):
        model = C.train(docs, spark.createDataFrame(labels, LABELS))
        assert model is None
        assert all(r.kept and r.score is None for r in C.score(docs, model).collect())
