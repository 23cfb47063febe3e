"""Archives: exact round trips, and revisits against grouping by payload."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import warc as W

SCHEMA = "page_id bigint, url string, html string, original string, record_type int"


def brute(rows: list[tuple], least: int) -> Counter:
    groups = defaultdict(list)
    for r in rows:
        groups[(r[2] or "").encode()].append(r[0])
    out = Counter()
    for r in rows:
        body = (r[2] or "").encode()
        ids = [i for i in groups[body] if i is not None]
        first = min(ids) if ids and len(body) >= least else None
        revisit = first is not None and r[0] != first
        out[r[0], len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
            "revisit" if revisit else "response", first if revisit else None] += 1
    return out


def pages(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    bodies = ["", None, "<p>é\U0001f600</p>", "a\r\n\r\nb", "WARC/1.1\r\n\r\n", "\r\n\r\n", "x" * 5000,
              "\x00\n\r", "HTTP/1.1 200 OK\r\n\r\n", "tail\r\n", "\r"]
    bodies += [f"<html>{draw.random()}</html>\n" * draw.randint(1, 9) for _ in range(20)]
    ids = draw.sample(range(-50, 1000), 150)
    rows = [(i, draw.choice([None, "http://a/é b", "http://x/\r\nWARC-Type: bad", ""]),
             draw.choice(bodies), "o", 1) for i in ids]
    return rows + [rows[0], rows[0], (None, "u", rows[0][2], None, None), (None, None, "only here", None, None)]


@pytest.mark.parametrize(("seed", "least", "limit"), [(1, 0, 10**6), (2, 30, 10**6), (3, 0, 2)])
def test_equals_grouping(spark, seed, least, limit, monkeypatch):
    """limit 2: more digests repeat than may be broadcast."""
    monkeypatch.setattr(W, "BROADCAST_IDS", limit)
    rows = pages(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = Counter(map(tuple, W.archived_pages(docs, least).collect()))
    assert found == brute(rows, least)


def test_payloads_are_not_shuffled(spark, tmp_path):
    """Headers are: the plan that brings the originals back to the pages has no exchange of rows."""
    plan = W.plan_records(spark.createDataFrame(pages(4), SCHEMA), f"file://{tmp_path}/p")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_any_gzip_reader_finds_the_records(spark, tmp_path):
    """Each record is a member, an empty one closes it; a split may begin anywhere in a file."""
    rows = pages(5)
    folder = f"file://{tmp_path}/w"
    W.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder, date="2024-05-06T07:08:09Z")
    (file,) = (tmp_path / "w/archives").glob("part-*")
    whole = gzip.decompress(file.read_bytes())
    assert len(list(W.parse(whole))) == len(rows)
    assert {h["warc-date"] for h, _ in W.parse(whole)} == {"2024-05-06T07:08:09Z"}
    members = file.read_bytes().split(W.CLOSING)
    assert members.pop() == b"" and len(members) == len(rows)
    assert all(len(list(W.parse(gzip.decompress(m)))) == 1 for m in members)


def test_files_may_be_larger_than_a_task(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="100KB", spark__sql__files__openCostInBytes="1KB")
    draw = random.Random(6)
    rows = [(i, "u", draw.randbytes(3000).hex(), "", 0) for i in range(300)]
    found = W.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{tmp_path}/w")
    assert found.rdd.getNumPartitions() > 5
    assert sorted(r.page_id for r in found.collect()) == list(range(300))


def test_payloads_and_headers_come_back(spark, tmp_path):
    rows = pages(3)
    W.write_archives(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/a")
    back = W.read_archives(spark, f"file://{tmp_path}/a/archives", payloads=True).collect()
    assert len(back) == len(rows)
    stored = {bytes(r.payload) for r in back if r.record_type == "response"}
    assert stored == {(r[2] or "").encode() for r in rows}
    assert all(r.payload is None and r.refers_to_record for r in back if r.record_type == "revisit")
    assert {r.uri for r in back} == {None, "", "http://a/é b", "http://x/%0D%0AWARC-Type: bad", "u"}


def test_damaged_payload_has_no_facts(spark):
    records = spark.createDataFrame(
        [("r", "response", 1, None, None, "A", "B", 3, None), ("s", "revisit", 2, None, "r", "A", None, None, None)],
        W.RECORDS)
    assert {tuple(r) for r in W.resolve(records).collect()} == {(1, None, None, "response", None), (2, None, None, "revisit", None)}


def test_digests(spark):
    text = spark.createDataFrame([("",), ("abc",)], "t string")
    got = [r[0] for r in text.select(W.base32(F.sha1(F.encode("t", "UTF-8")))).collect()]
    assert got == [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in (b"", b"abc")]


def test_no_rows_and_long_page(spark):
    assert W.archived_pages(spark.createDataFrame([], SCHEMA)).collect() == []
    row = W.archived_pages(spark.createDataFrame([(1, "u", "é" * 3_000_000, "", 0)], SCHEMA)).first()
    assert (row.payload_bytes, row.record_type) == (6_000_000, "response")
