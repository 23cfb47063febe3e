"""Registry of the nine raw sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class RawSource:
    """Columns a source must carry, found by header name; extra ones are ignored.

    ``free_text`` marks sources whose quoted fields may hold line breaks.
    """

    columns: tuple[str, ...]
    free_text: bool = False


# Column names as the extracts spell them.
RAW_SOURCES: dict[str, RawSource] = {
    "customers": RawSource((
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )),
    "orders": RawSource((
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )),
    "order_items": RawSource((
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    )),
    "order_payments": RawSource((
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    )),
    "order_reviews": RawSource((
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ), free_text=True),
    "products": RawSource((
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )),
    "sellers": RawSource((
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )),
    "geolocation": RawSource((
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    )),
    "product_category_name_translation": RawSource((
        "product_category_name",
        "product_category_name_english",
    )),
}


def source_path(
    base: str,
    name: str,
    pattern: str = "{name}.csv",
    file_names: Mapping[str, str] | None = None,
) -> str:
    """Location of a source: its own entry in ``file_names``, else ``pattern``."""
    if name not in RAW_SOURCES:
        raise KeyError(f"unknown raw source {name!r}; known: {', '.join(RAW_SOURCES)}")
    file_name = (file_names or {}).get(name) or pattern.format(name=name)
    return f"{base.rstrip('/')}/{file_name}"
