"""Phrase removal against looking every run up in a dictionary."""

from __future__ import annotations

import hashlib
import random

import pytest

from starmart.llm import phrases
from starmart.llm.phrases import remove_repeats

SCHEMA = "doc_id bigint, text string, place int, n_words string"


def brute(rows: list[tuple], window: int) -> list[tuple]:
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    first: dict[tuple, int] = {}
    for doc, w in split:
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            if doc is not None:
                first[run] = min(first.get(run, doc), doc)
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows: list[tuple], window: int, phrase: int) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(r) for r in remove_repeats(docs, window, phrase).collect()), key=str)


@pytest.mark.parametrize(("seed", "window", "phrase"), [(1, 50, 25), (2, 8, 4), (3, 5, 5)])
def test_equals_dictionary(spark, seed, window, phrase):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [draw.choices(vocabulary, k=k) for k in (window, window + 1, window + 30, window - 1)]
    texts = []
    for _ in range(60):
        text = draw.choices(vocabulary, k=draw.randint(0, 3 * window))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(text))
            text[at:at] = draw.choice(passages)
        texts.append(draw.choice([" ", "\n", " \t "]).join(text))
    texts += texts[:5] + [None, "", " ", "x " * (4 * window), "y " + "x " * (3 * window), "é " * window]
    ids = draw.sample(range(10_000), len(texts))
    rows = [(i, t, 1, "c") for i, t in zip(ids, texts, strict=True)]
    rows += [rows[0], (None, rows[1][1], 1, None), (rows[2][0], rows[3][1], 1, None), (None, None, None, None)]
    assert result(spark, rows, window, phrase) == brute(rows, window)


def test_no_rows(spark):
    assert result(spark, [], 50, 25) == []


def test_long_text_and_long_word(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(5, long, 1, "c"), (6, "a " + long, 1, "c"), (7, "b" * 2_500_000, 1, "c")]
    assert result(spark, rows, 50, 25) == brute(rows, 50)


def test_few_rows_fill_few_files(spark, settings, monkeypatch, tmp_path):
    """Executors start processes (chmod) for every file they write on a local disk."""
    draw = random.Random(4)
    texts = [" ".join(f"w{draw.randrange(1_000_000)}" for _ in range(400)) for _ in range(300)]
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)] + [(300, texts[0] + " end", 1, "c")]
    settings(
        spark__sql__shuffle__partitions="12",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="4k",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    monkeypatch.setattr(phrases, "scratch", lambda session, name: f"file://{tmp_path}/{name}")
    assert result(spark, rows, 50, 25) == brute(rows, 50)
    files = {t: len(list((tmp_path / "phrases" / t).glob("*.parquet"))) for t in ("recurring", "owners")}
    assert max(files.values()) <= 3, files
