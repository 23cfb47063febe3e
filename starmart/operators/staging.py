"""Staging: one typed, cleaned table per raw source.

Every function is a projection of its source (products also look up their
category), so staging adds no shuffle and can be read as a view.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import (
    blank_to_null,
    to_double,
    to_int,
    to_text,
    to_timestamp,
)

UNKNOWN_CATEGORY = "unknown"


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        to_text(customers, "customer_id"),
        to_text(customers, "customer_unique_id"),
        to_int(customers, "customer_zip_code_prefix"),
        "customer_city",
        F.upper("customer_state").alias("customer_state"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Every order has a purchase time: empty text there is an error, not NULL."""
    return orders.select(
        to_text(orders, "order_id"),
        to_text(orders, "customer_id"),
        "order_status",
        to_timestamp(orders, "order_purchase_timestamp", blank_is_null=False),
        to_timestamp(orders, "order_approved_at"),
        to_timestamp(orders, "order_delivered_carrier_date"),
        to_timestamp(orders, "order_delivered_customer_date"),
        to_timestamp(orders, "order_estimated_delivery_date"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        to_text(items, "order_id"),
        to_int(items, "order_item_id"),
        to_text(items, "product_id"),
        to_text(items, "seller_id"),
        to_timestamp(items, "shipping_limit_date"),
        to_double(items, "price"),
        to_double(items, "freight_value"),
    )


def stg_order_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        to_text(payments, "order_id"),
        to_int(payments, "payment_sequential"),
        "payment_type",
        to_int(payments, "payment_installments"),
        to_double(payments, "payment_value"),
    )


def stg_order_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        to_text(reviews, "review_id"),
        to_text(reviews, "order_id"),
        to_int(reviews, "review_score"),
        blank_to_null(reviews, "review_comment_title"),
        blank_to_null(reviews, "review_comment_message"),
        to_timestamp(reviews, "review_creation_date"),
        to_timestamp(reviews, "review_answer_timestamp"),
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category, ``unknown`` where there is none.

    No broadcast hint: Spark broadcasts the translation when its known size is
    under the session's threshold, and otherwise joins two plain shuffles, whose
    hot categories adaptive execution splits.
    """
    english = translation.select("product_category_name", "product_category_name_english")
    return products.join(english, "product_category_name", "left").select(
        to_text(products, "product_id"),
        "product_category_name",
        F.coalesce("product_category_name_english", F.lit(UNKNOWN_CATEGORY)).alias(
            "product_category_name_english"
        ),
        to_int(products, "product_weight_g"),
        to_int(products, "product_length_cm"),
        to_int(products, "product_height_cm"),
        to_int(products, "product_width_cm"),
        to_int(products, "product_photos_qty"),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        to_text(sellers, "seller_id"),
        to_int(sellers, "seller_zip_code_prefix"),
        "seller_city",
        F.upper("seller_state").alias("seller_state"),
    )


# Staged tables and the raw sources each reads; geolocation is landed only.
STAGED = {
    "stg_customers": (stg_customers, ("customers",)),
    "stg_orders": (stg_orders, ("orders",)),
    "stg_order_items": (stg_order_items, ("order_items",)),
    "stg_order_payments": (stg_order_payments, ("order_payments",)),
    "stg_order_reviews": (stg_order_reviews, ("order_reviews",)),
    "stg_products": (stg_products, ("products", "product_category_name_translation")),
    "stg_sellers": (stg_sellers, ("sellers",)),
}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staged tables by name."""
    return {
        name: function(*[raw[source] for source in sources])
        for name, (function, sources) in STAGED.items()
    }
