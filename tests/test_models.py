"""Staging, rollups, dimensions and facts on the hand-written orders."""

from datetime import date, datetime
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from starmart.operators import rollups
from starmart.operators.dimensions import date_bounds, dim_date
from starmart.operators.staging import stage_all
from starmart.plans import pipeline
from starmart.sources import read_all_raw
from starmart.sources.catalog import RAW_SOURCES
from tests.conftest import failing
from tests.fixtures import CSV, write_sources

NAMES = [name for name in RAW_SOURCES if name != "geolocation"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    base = write_sources(tmp_path_factory.mktemp("raw"))
    return stage_all(read_all_raw(spark, base, names=NAMES))


@pytest.fixture(scope="module")
def marts(staged):
    return pipeline.model(staged)


@pytest.fixture(scope="module")
def orders(marts):
    return {row.order_id: row for row in marts["fact_orders"].collect()}


def key(text):
    return md5(text.encode()).hexdigest()


SCHEMAS = {
    "stg_customers": "customer_id string, customer_unique_id string, "
    "customer_zip_code_prefix int, customer_city string, customer_state string",
    "stg_orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz",
    "stg_order_items": "order_id string, order_item_id int, product_id string, "
    "seller_id string, shipping_limit_date timestamp_ntz, price double, freight_value double",
    "stg_order_payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double",
    "stg_order_reviews": "review_id string, order_id string, review_score int, "
    "review_comment_title string, review_comment_message string, "
    "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
    "stg_products": "product_id string, product_category_name string, "
    "product_category_name_english string, product_weight_g int, product_length_cm int, "
    "product_height_cm int, product_width_cm int, product_photos_qty int",
    "stg_sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, "
    "seller_state string",
    "dim_date": "date_sk int, date_day date, year bigint, quarter bigint, month bigint, "
    "month_name string, day_of_month bigint, day_of_week bigint, day_name string, "
    "is_weekend boolean",
    "fact_orders": "order_sk string, order_id string, customer_sk string, order_date_sk int, "
    "order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz, items_count bigint, total_price double, "
    "total_freight double, total_order_value double, total_payment double, "
    "max_installments int, avg_review_score double, review_count bigint, "
    "delivery_days bigint, delivered_on_time boolean",
    "fact_order_items": "order_item_sk string, order_id string, order_item_id int, "
    "customer_sk string, product_sk string, seller_sk string, order_date_sk int, "
    "order_status string, price double, freight_value double, item_total double",
}
for _dim, _stage in {"customer": "customers", "product": "products", "seller": "sellers"}.items():
    SCHEMAS[f"dim_{_dim}"] = f"{_dim}_sk string, " + SCHEMAS[f"stg_{_stage}"]


@pytest.mark.parametrize("name", SCHEMAS)
def test_schema(name, staged, marts):
    table = {**staged, **marts}[name]
    assert ", ".join(f"{n} {k}" for n, k in table.dtypes) == SCHEMAS[name]


def test_staged_values(staged):
    customers = {r.customer_id: r for r in staged["stg_customers"].collect()}
    assert customers["c1"].customer_zip_code_prefix == 1037
    assert customers["c1"].customer_state == "SP"
    assert customers["c3"].customer_zip_code_prefix is None
    reviews = {r.review_id: r for r in staged["stg_order_reviews"].collect()}
    assert reviews["r2"].review_comment_title is None
    assert reviews["r3"].review_comment_title == " "
    assert reviews["r1"].review_answer_timestamp == datetime(2018, 1, 3, 12, 30)


def test_category_without_translation_is_unknown(staged):
    products = {r.product_id: r for r in staged["stg_products"].collect()}
    english = {p: r.product_category_name_english for p, r in products.items()}
    assert english == {"p1": "toys", "p2": "unknown", "p3": "unknown"}
    assert products["p3"].product_category_name is None
    assert products["p2"].product_weight_g == 13


def test_purchase_time_from_csv_and_from_text(spark, tmp_path):
    header = CSV["orders"].splitlines()[0]
    base = write_sources(tmp_path, orders=f"{header}\no1,c1,delivered,,,,,\n")
    raw = read_all_raw(spark, base, names=NAMES)
    assert stage_all(raw)["stg_orders"].first().order_purchase_timestamp is None
    raw["orders"] = raw["orders"].withColumn("order_purchase_timestamp", F.lit(""))
    with failing("order_purchase_timestamp"):
        stage_all(raw)["stg_orders"].collect()


def test_order_without_children_has_null_measures(orders):
    row = orders["o2"]
    assert (row.items_count, row.total_price, row.total_order_value) == (None, None, None)
    assert (row.total_payment, row.max_installments, row.review_count) == (None, None, None)


def test_order_with_only_a_payment_has_zeros(orders):
    row = orders["o3"]
    assert (row.items_count, row.total_price, row.total_order_value) == (0, 0.0, 0.0)
    assert (row.total_payment, row.max_installments) == (55.0, 1)
    assert (row.avg_review_score, row.review_count) == (None, 0)


def test_rolled_up_measures(orders):
    row = orders["o1"]
    assert (row.items_count, row.total_price, row.total_freight) == (2, 30.5, 3.25)
    assert (row.total_order_value, row.total_payment, row.max_installments) == (33.75, 33.75, 3)
    assert (row.avg_review_score, row.review_count) == (4.5, 2)


def test_delivery_over_midnight_is_one_day(orders):
    assert orders["o1"].delivery_days == 1
    assert orders["o1"].delivered_on_time is True
    assert orders["o3"].delivery_days is None
    assert orders["o3"].delivered_on_time is None


def test_delivery_without_estimate_is_late(orders):
    assert orders["o4"].delivered_on_time is False


def test_children_of_unknown_orders(staged, marts, orders):
    children = [staged[n] for n in ("stg_order_items", "stg_order_payments", "stg_order_reviews")]
    ids = {r.order_id for r in rollups.order_metrics(*children).collect()}
    assert {"ox", "oy", "oz"} <= ids
    assert {"ox", "oy", "oz"}.isdisjoint(orders)
    items = marts["fact_order_items"].collect()
    assert sorted(r.order_id for r in items) == ["o1", "o1", "o4", "o5"]


def test_foreign_keys_are_hashes_of_natural_keys(marts, orders):
    assert orders["o5"].customer_sk == key("c9")
    assert orders["o1"].order_date_sk == 20171231
    row = marts["fact_order_items"].filter("order_id = 'o4'").first()
    assert row.order_item_sk == key("o4||1")
    assert (row.customer_sk, row.product_sk, row.seller_sk) == (key("c3"), key("p3"), key("s2"))
    assert row.item_total == -4.0


def test_dates_cover_the_history_without_gaps(marts):
    days = {r.date_day: r for r in marts["dim_date"].collect()}
    assert len(days) == 8
    saturday, sunday = days[date(2018, 1, 6)], days[date(2018, 1, 7)]
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (6, "Saturday", True)
    assert (sunday.day_of_week, sunday.is_weekend) == (0, True)
    first = days[date(2017, 12, 31)]
    assert (first.date_sk, first.year, first.quarter, first.month) == (20171231, 2017, 4, 12)
    assert (first.month_name, first.day_of_month) == ("December", 31)
    assert days[date(2018, 1, 5)].is_weekend is False


def test_single_day_and_empty_history(staged):
    orders = staged["stg_orders"]
    assert dim_date(orders.filter("order_id = 'o1'")).count() == 1
    nothing = orders.filter("order_id = 'none'")
    assert dim_date(nothing).count() == 0
    assert date_bounds(nothing).first().asDict() == {"min_date": None, "max_date": None}


def test_metrics_keep_orphans_apart_as_outer_joins_do(spark):
    items = spark.createDataFrame(
        [(None, 1.0, 1.0), (None, 2.0, None), ("a", None, 3.0), ("b", 4.0, 0.5)],
        "order_id string, price double, freight_value double",
    )
    payments = spark.createDataFrame(
        [(None, 5.0, 2), ("a", None, None), ("c", 7.0, 4)],
        "order_id string, payment_value double, payment_installments int",
    )
    reviews = spark.createDataFrame(
        [(None, 3), ("c", None), ("d", 5), ("d", 4)], "order_id string, review_score int"
    )
    joined = rollups.order_metrics_joined(items, payments, reviews)
    stacked = rollups.order_metrics(items, payments, reviews)
    assert stacked.dtypes == joined.dtypes
    assert sorted(map(str, stacked.collect())) == sorted(map(str, joined.collect()))
    assert stacked.filter("order_id IS NULL").count() == 3
    known = rollups.order_metrics(items, payments, reviews, known_orders_only=True)
    expected = joined.filter("order_id IS NOT NULL")
    assert sorted(map(str, known.collect())) == sorted(map(str, expected.collect()))
