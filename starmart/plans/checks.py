"""The warehouse's 64 checks."""

from __future__ import annotations

from starmart.plans.quality import (
    Check,
    accepted_values,
    no_rows_where,
    not_null,
    relationships,
    unique,
)

# The value sets the sources may use.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "processing",
    "invoiced",
    "unavailable",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)

# Columns that identify a row: neither NULL nor repeated.
KEYS = {
    "stg_customers": ["customer_id"],
    "stg_orders": ["order_id"],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "dim_customer": ["customer_sk", "customer_id"],
    "dim_product": ["product_sk", "product_id"],
    "dim_seller": ["seller_sk", "seller_id"],
    "dim_date": ["date_sk", "date_day"],
    "fact_orders": ["order_sk", "order_id"],
    "fact_order_items": ["order_item_sk"],
}

# Further columns that must be filled.
FILLED = {
    "stg_customers": ["customer_unique_id", "customer_state"],
    "stg_orders": ["customer_id", "order_status"],
    "stg_order_items": ["order_id", "product_id", "seller_id", "price"],
    "stg_order_payments": ["order_id", "payment_type"],
    "stg_order_reviews": ["review_id", "review_score"],
    "dim_customer": ["customer_state"],
    "dim_product": ["product_category_name_english"],
    "fact_orders": ["customer_sk", "order_date_sk", "total_order_value"],
    "fact_order_items": ["customer_sk", "product_sk", "seller_sk", "order_date_sk", "price"],
}

CHECKS: tuple[Check, ...] = (
    *(c for t, names in KEYS.items() for n in names for c in (not_null(t, n), unique(t, n))),
    *(not_null(t, n) for t, names in FILLED.items() for n in names),
    accepted_values("stg_orders", "order_status", ORDER_STATUSES),
    accepted_values("stg_order_payments", "payment_type", PAYMENT_TYPES),
    accepted_values("stg_order_reviews", "review_score", REVIEW_SCORES),
    relationships("stg_orders", "customer_id", "stg_customers", "customer_id"),
    relationships("stg_order_items", "order_id", "stg_orders", "order_id"),
    relationships("fact_orders", "customer_sk", "dim_customer", "customer_sk"),
    relationships("fact_orders", "order_date_sk", "dim_date", "date_sk"),
    relationships("fact_order_items", "customer_sk", "dim_customer", "customer_sk"),
    relationships("fact_order_items", "product_sk", "dim_product", "product_sk"),
    relationships("fact_order_items", "seller_sk", "dim_seller", "seller_sk"),
    relationships("fact_order_items", "order_date_sk", "dim_date", "date_sk"),
    no_rows_where(
        "fact_orders_value_not_negative",
        "fact_orders",
        "total_order_value",
        "total_order_value < 0",
    ),
)
