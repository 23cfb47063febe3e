"""Conformed dimensions, overwritten on every build (Type 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import date_key, date_spine, day_of_week, surrogate_key


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer_id; customer_unique_id rolls up to the person."""
    return customers.select(surrogate_key("customer_id").alias("customer_sk"), "*")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(surrogate_key("product_id").alias("product_sk"), "*")


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(surrogate_key("seller_id").alias("seller_sk"), "*")


def date_bounds(orders: DataFrame) -> DataFrame:
    """First and last purchase date; one row, NULLs without orders."""
    purchased = F.col("order_purchase_timestamp")
    return orders.agg(
        F.min(purchased).cast("date").alias("min_date"),
        F.max(purchased).cast("date").alias("max_date"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day of the order history, gaps included."""
    day = F.col("date_day")
    days = date_spine(date_bounds(orders), "min_date", "max_date", "date_day")
    return days.select(
        date_key(day).alias("date_sk"),
        "date_day",
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
    )
