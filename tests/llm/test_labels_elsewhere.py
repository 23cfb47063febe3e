"""Labels that also cover documents of other tables do not shrink the fit."""

from __future__ import annotations

from starmart.llm import rules, secrets


def tables(spark):
    docs = [(i, f"some plain words of text number {i}") for i in range(40)]
    labels = [(i, 1) for i in range(20)] + [(i, 1) for i in range(1000, 6000)] + [(None, 1)]
    return (spark.createDataFrame([*docs, (None, "no id")], "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int"))


def test_rules_fit_on_labelled_documents_that_are_here(spark):
    docs, labels = tables(spark)
    found = [r.doc_id for r in rules.labelled_statistics(docs, labels, most=12).collect()]
    assert len(set(found)) == len(found) == 12 and set(found) <= set(range(20))


def test_secrets_fit_on_labelled_documents_that_are_here(spark):
    docs, labels = tables(spark)
    found = secrets.samples(docs, labels, most=12).where("is_random")
    assert found.count() == 2 * 12
