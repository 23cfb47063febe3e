"""Facts at order and at order line grain.

Foreign keys are hashes of the natural keys, so facts never wait for or join a
dimension; a key without its dimension row shows up in the quality checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import date_key, days_between, surrogate_key
from starmart.operators.skew import HotKeys, left_join_unique


def delivered_on_time(delivered: Column, estimated: Column) -> Column:
    """NULL until delivered; a delivery without an estimate is not on time."""
    return F.when(delivered.isNotNull(), F.coalesce(delivered <= estimated, F.lit(False)))


def fact_orders(
    orders: DataFrame, metrics: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """One row per order, with the measures of its children.

    An order without any child keeps NULL measures: the zeros of ``metrics``
    stand for children missing of one kind, not for no children at all.
    ``hot`` names order ids that repeat very often among the orders, where that is
    known; else the plan looks for them itself.
    """
    return keyed_orders(order_rows(orders, metrics, hot))


def order_rows(
    orders: DataFrame, metrics: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Orders and measures under natural keys, which take a fraction of the hashes' bytes."""
    return left_join_unique(orders, metrics, "order_id", hot).select(
        "order_id",
        "customer_id",
        date_key(F.col("order_purchase_timestamp")).alias("order_date_sk"),
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "items_count",
        "total_price",
        "total_freight",
        "total_payment",
        "max_installments",
        "avg_review_score",
        "review_count",
    )


def keyed_orders(rows: DataFrame) -> DataFrame:
    """The order fact from its rows, in any layout."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return rows.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id",
        surrogate_key("customer_id").alias("customer_sk"),
        "order_date_sk",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "items_count",
        "total_price",
        "total_freight",
        (F.col("total_price") + F.col("total_freight")).alias("total_order_value"),
        "total_payment",
        "max_installments",
        "avg_review_score",
        "review_count",
        days_between(purchased, delivered).alias("delivery_days"),
        delivered_on_time(delivered, estimated).alias("delivered_on_time"),
    )


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per line of a known order.

    Both inputs are plain shuffles on order_id, narrowed to the columns used, so
    adaptive execution can split an order that holds very many lines. Keys are
    hashed behind the join: a hash is several times as long as what it is made of.
    """
    return keyed_lines(line_rows(items, orders))


def line_rows(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of known orders under natural keys."""
    header = orders.select(
        "order_id",
        "customer_id",
        date_key(F.col("order_purchase_timestamp")).alias("order_date_sk"),
        "order_status",
    )
    return items.join(header, "order_id", "inner").select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_date_sk",
        "order_status",
        "price",
        "freight_value",
    )


def keyed_lines(rows: DataFrame) -> DataFrame:
    """The line fact from its rows, in any layout."""
    return rows.select(
        surrogate_key("order_id", "order_item_id").alias("order_item_sk"),
        "order_id",
        "order_item_id",
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        surrogate_key("seller_id").alias("seller_sk"),
        "order_date_sk",
        "order_status",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
    )
