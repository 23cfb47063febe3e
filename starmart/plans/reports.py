"""Report queries over the marts.

Reports that look up a dimension first sum the fact per foreign key and count the
dimension rows per key and attribute. Both sums combine map-side, so neither a
key holding a third of the facts nor a repeated dimension row gathers in one task
or multiplies rows in the join; the counts then weight the sums, which gives the
same totals as joining row by row. Spark broadcasts the dimension side when its
measured size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import month_start

TOP = 10


def delivered_kpis(fact_orders: DataFrame) -> DataFrame:
    """One row on delivered orders; the review score is a mean of order means."""
    delivered = fact_orders.filter(F.col("order_status") == "delivered")
    return delivered.agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_order_value").alias("revenue"),
        F.avg("avg_review_score").alias("avg_review"),
        F.avg("delivery_days").alias("avg_delivery_days"),
    )


def monthly_revenue(fact_orders: DataFrame) -> DataFrame:
    """Revenue of all orders, whatever their status, by purchase month."""
    month = month_start(F.col("order_purchase_timestamp"))
    return (
        fact_orders.groupBy(month.alias("month"))
        .agg(F.sum("total_order_value").alias("revenue"))
        .orderBy(F.asc_nulls_last("month"))
    )


def top_categories(fact_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    sold = fact_order_items.groupBy("product_sk").agg(F.sum("item_total").alias("sold"))
    categories = _copies(dim_product, "product_sk", "product_category_name_english")
    return (
        sold.join(categories, "product_sk")
        .groupBy(F.col("product_category_name_english").alias("category"))
        .agg(F.sum(F.col("sold") * F.col("copies")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
        .limit(TOP)
    )


def state_revenue(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    spent = fact_orders.groupBy("customer_sk").agg(F.sum("total_order_value").alias("spent"))
    states = _copies(dim_customer, "customer_sk", "customer_state")
    return (
        spent.join(states, "customer_sk")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.sum(F.col("spent") * F.col("copies")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("state"))
    )


def installment_distribution(fact_orders: DataFrame) -> DataFrame:
    """Orders by their longest instalment plan; orders without payment drop out."""
    paid = fact_orders.filter(F.col("max_installments") > 0)
    return (
        paid.groupBy(F.col("max_installments").alias("installments"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("installments")
    )


def top_sellers(fact_order_items: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Best sellers with their exact number of distinct orders.

    Distinct orders are counted for the ten winners only: counting them for all
    sellers would shuffle every line of the fact. The winners' rows carry their
    revenue through the second pass, so it is computed once and stays the same.
    """
    sold = fact_order_items.groupBy("seller_sk").agg(F.sum("item_total").alias("sold"))
    sellers = _copies(dim_seller, "seller_sk", "seller_id", "seller_state")
    revenue = (F.col("sold") * F.col("copies")).alias("revenue")
    order = (
        F.desc("revenue"),
        F.asc_nulls_last("seller_id"),
        F.asc_nulls_last("seller_state"),
    )
    best = (
        sold.join(sellers, "seller_sk")
        .select("seller_sk", "seller_id", "seller_state", revenue)
        .orderBy(*order)
        .limit(TOP)
    )
    lines = fact_order_items.select("seller_sk", "order_id")
    # TOP rows at most.
    return (
        lines.join(F.broadcast(best), "seller_sk")
        .groupBy("seller_sk", "seller_id", "seller_state", "revenue")
        .agg(F.count_distinct("order_id").alias("orders"))
        .select("seller_id", "seller_state", "orders", "revenue")
        .orderBy(*order)
    )


def status_summary(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_order_value").alias("revenue"),
    )


def _copies(dimension: DataFrame, *columns: str) -> DataFrame:
    return dimension.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
