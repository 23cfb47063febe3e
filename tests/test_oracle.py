"""Every registered query against its oracle on the driver's tables."""

import re

import pytest

import __spark_entry__ as entry_point
from tests.compare import differences, oracle_connection

SF_DIR = "/root/testdata/sf0.001"
# The training-data operators, where they are installed, are tested beside their own code.
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in entry_point.queries().items() if not OTHERS.match(k)}
ORACLES = {k: v for k, v in entry_point.oracle_sql().items() if not OTHERS.match(k)}


@pytest.fixture(scope="module")
def connection():
    with oracle_connection(SF_DIR) as opened:
        yield opened


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(name, spark, connection):
    assert differences(QUERIES[name], ORACLES[name], spark, SF_DIR, connection) == []


@pytest.mark.parametrize(
    "name",
    ["stg_orders", "dim_date", "fact_orders", "fact_order_items", "rpt_monthly_revenue",
     "dq_summary", "fn_dates", "fn_casts", "surrogate_key"],
)
def test_results_do_not_depend_on_the_session(name, spark, connection, settings):
    settings(
        spark__sql__session__timeZone="America/Sao_Paulo",
        spark__sql__ansi__enabled="false",
        spark__sql__adaptive__enabled="false",
    )
    assert differences(QUERIES[name], ORACLES[name], spark, SF_DIR, connection) == []


def test_flagship_query_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
