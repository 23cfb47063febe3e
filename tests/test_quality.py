"""Each check with passing and failing input, alone and in the fused summary."""

from collections import Counter

import os

import pytest

from starmart.plans import quality
from starmart.plans.checks import CHECKS
from starmart.plans.quality import (
    accepted_values,
    failures,
    no_rows_where,
    not_null,
    relationships,
    summarise,
    unique,
)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "good": spark.createDataFrame(
            [("a", 1, 5.0), ("b", 2, 0.0), ("c", None, None)], "id string, score int, v double"
        ),
        "bad": spark.createDataFrame(
            [("a", 1, -1.0), ("a", 9, 2.0), ("x", 9, -3.0), ("x", 8, None), (None, None, 1.0),
             (None, 1, 1.0)],
            "id string, score int, v double",
        ),
    }


# check, number of failures, and rows of the failure query
CASES = [
    (not_null("good", "id"), 0, []),
    (not_null("bad", "id"), 2, [(None, 1, 1.0), (None, None, 1.0)]),
    (not_null("bad", "v"), 1, [("x", 8, None)]),
    (unique("good", "id"), 0, []),
    (unique("bad", "id"), 2, [("a", 2), ("x", 2)]),
    (accepted_values("good", "score", [1, 2, 3]), 0, []),
    (accepted_values("bad", "score", [1, 2, 3]), 2, [(8, 1), (9, 2)]),
    (relationships("good", "id", "good", "id"), 0, []),
    (relationships("bad", "id", "good", "id"), 2, [("x",), ("x",)]),
    (relationships("good", "id", "bad", "id"), 2, [("b",), ("c",)]),
    (no_rows_where("good_not_negative", "good", "v", "v < 0"), 0, []),
    (no_rows_where("bad_not_negative", "bad", "v", "v < 0"), 2, [("a", 1, -1.0), ("x", 9, -3.0)]),
]


@pytest.mark.parametrize(("check", "count", "rows"), CASES, ids=[c[0].test for c in CASES])
def test_failing_rows(check, count, rows, tables):
    found = [tuple(row) for row in failures(check, tables).collect()]
    assert sorted(map(str, found)) == sorted(map(str, rows))
    assert len(found) == count


def test_summary_agrees_with_each_check(spark, tables):
    result = summarise(spark, [case[0] for case in CASES], tables).collect()
    assert Counter(row.test for row in result) == Counter(case[0].test for case in CASES)
    by_place = {(r.test, r.table, r.column): r for r in result}
    for check, count, _ in CASES:
        row = by_place[check.test, check.table, check.column]
        assert (row.failures, row.passed) == (count, count == 0), check


def test_summary_of_one_kind_alone(spark, tables):
    only = summarise(spark, [not_null("bad", "v")], tables).collect()
    assert [(r.failures, r.passed) for r in only] == [(1, False)]


def test_summary_of_empty_tables(spark, tables):
    empty = {name: table.filter("false") for name, table in tables.items()}
    result = summarise(spark, [case[0] for case in CASES], empty).collect()
    assert len(result) == len(CASES)
    assert all(row.passed for row in result)


def test_quotes_in_accepted_values(spark):
    table = spark.createDataFrame([("it's",), ("a\\b",), ("no",)], "x string")
    check = accepted_values("t", "x", ["it's", "a\\b"])
    assert [tuple(r) for r in failures(check, {"t": table}).collect()] == [("no", 1)]
    assert summarise(spark, [check], {"t": table}).first().failures == 1


def test_unknown_kind(tables):
    from starmart.plans.quality import Check

    with pytest.raises(ValueError):
        failures(Check("odd", "good", "id"), tables)


def test_the_registered_checks():
    kinds = Counter(check.kind for check in CHECKS)
    assert len(CHECKS) == 64
    assert kinds == {
        "not_null": 37, "unique": 15, "relationships": 8, "accepted_values": 3, "singular": 1
    }
    tables = Counter(check.table for check in CHECKS)
    assert tables == {
        "stg_customers": 4, "stg_orders": 6, "stg_order_items": 5, "stg_order_payments": 3,
        "stg_order_reviews": 3, "stg_products": 2, "stg_sellers": 2, "dim_customer": 5,
        "dim_product": 5, "dim_seller": 4, "dim_date": 4, "fact_orders": 10,
        "fact_order_items": 11,
    }
    assert len({check.test for check in CHECKS}) == 64


KEYS = {
    "int": "CAST(id AS INT)", "bigint": "id", "double": "CAST(id AS DOUBLE)",
    "string": "if(id % 3 = 0, concat('0', id), CAST(id AS STRING))",
    "decimal": "CAST(id AS DECIMAL(10, 2))",
    "date": "date_add(DATE'2020-01-01', CAST(id AS INT))",
    "timestamp_ntz": "CAST(date_add(DATE'2020-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ)",
}
NUMERIC = ["int", "bigint", "double", "string", "decimal"]


@pytest.mark.parametrize(
    ("child", "parent"),
    [(a, b) for a in NUMERIC for b in NUMERIC]
    + [("date", "timestamp_ntz"), ("timestamp_ntz", "date"), ("date", "string")],
)
def test_keys_of_different_types_count_as_their_rows(spark, child, parent):
    odd = spark.sql("SELECT 'none' AS k UNION ALL SELECT NULL") if child == "string" else None
    children = spark.range(12).selectExpr(f"{KEYS[child]} AS k")
    if odd is not None:
        children = children.unionAll(odd)
    made = {"c": children, "p": spark.range(9).selectExpr(f"{KEYS[parent]} AS k")}
    checks = [
        quality.relationships("c", "k", "p", "k"), quality.unique("c", "k"),
        quality.not_null("c", "k"), quality.unique("p", "k"),
    ]
    if child in NUMERIC:
        checks.append(quality.accepted_values("c", "k", [1, 2, 4]))
    found = {r.test: r.failures for r in quality.summarise(spark, checks, made).collect()}
    assert found == {c.test: quality.failures(c, made).count() for c in checks}
    if child in NUMERIC and parent in NUMERIC and child != "string" and parent != "string":
        assert found[checks[0].test] == 3


def test_negative_zero_is_zero(spark):
    made = {"c": spark.sql("SELECT -0.0D AS k"), "p": spark.sql("SELECT 0.0D AS k")}
    check = quality.relationships("c", "k", "p", "k")
    assert quality.summarise(spark, [check], made).first().failures == 0
    assert quality.failures(check, made).count() == 0


def test_keys_that_spell_the_bytes_of_others_are_not_them(spark):
    """'7a7a' is hex for the bytes of 'zz'; case, odd lengths and empty text matter too."""
    keys = ["zz", "7a7a", "7A7A", "07a7a", "7a7", "", "ab", "AB", None, "é", "c3a9", "7a7a"]
    parents = ["zz", "AB", "c3a9", "", "07a7a"]
    tables = {
        "child": spark.createDataFrame([(k,) for k in keys], "k string"),
        "parent": spark.createDataFrame([(k,) for k in parents], "k string"),
    }
    checks = [
        quality.unique("child", "k"),
        quality.not_null("child", "k"),
        quality.relationships("child", "k", "parent", "k"),
        quality.unique("parent", "k"),
    ]
    found = [row.failures for row in quality.summarise(spark, checks, tables).collect()]
    assert found == [quality.failures(c, tables).count() for c in checks] == [1, 1, 6, 0]
    listed = [quality.accepted_values("child", "k", ["zz", "ab", "", "AB"])]
    (row,) = quality.summarise(spark, listed, tables).collect()
    assert row.failures == quality.failures(listed[0], tables).count() == 6


def test_hashes_are_shuffled_as_bytes(spark):
    """A hundred thousand distinct md5 texts of 32 bytes each."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f and f.endswith(".data")}

    before = shuffled()
    hashes = spark.range(100_000).selectExpr("md5(CAST(id AS STRING)) AS k")
    summary = quality.summarise(spark, [quality.unique("t", "k")], {"t": hashes})
    assert [row.failures for row in summary.collect()] == [0]
    assert sum(os.path.getsize(f) for f in shuffled() - before) < 3_000_000
