"""Co-training draws on every unlabelled document."""

from __future__ import annotations

from starmart.llm import cotraining as C
from tests.llm.test_cotraining import LABELS, SCHEMA, corpus


def test_surest_are_drawn_from_all_unlabelled_documents(spark, monkeypatch):
    rows, good = corpus(4, 4700)
    docs = spark.createDataFrame([*rows, rows[200], (300, "else", *rows[300][2:])], SCHEMA).repartition(4)
    labels = [(i, good[i], 0) for i in range(200)]
    offered, surest = [], C._surest

    def seen(scored, prior):
        offered.append([r.doc_id for r in scored.select("doc_id").collect()])
        return surest(scored, prior)

    monkeypatch.setattr(C, "_surest", seen)
    monkeypatch.setattr(C, "SURE", 0.5)
    assert C.train(docs, spark.createDataFrame(labels, LABELS), rounds=1)
    assert [sorted(ids) for ids in offered] == [list(range(200, 4700))] * 2


def test_scores_come_from_the_features_of_training(spark):
    """The same rows as with features made anew, repeated and NULL ids included; texts are cut once."""
    rows, good = corpus(5, 400)
    odd = [(None, *rows[7][1:]), (None,) * 7, (9, "else", *rows[9][2:]), rows[11]]
    docs = spark.createDataFrame([*rows, *odd], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, good[i], 0) for i in range(120)], LABELS)
    found = C.train_and_score(docs, labels, rounds=1)
    expected = C.score(docs, C.train(docs, labels, rounds=1))
    assert found.dtypes == expected.dtypes and found.count() == 404
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    text = found._jdf.queryExecution().toString()
    assert "regexp" not in text and "regexp" in expected._jdf.queryExecution().toString()
    none = labels.where("false")
    assert C.train_and_score(docs, none).where("kept").count() == 404
