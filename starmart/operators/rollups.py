"""Children of an order collapsed to one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def item_rollup(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items_count"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight"),
    )


def payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment"),
        F.max("payment_installments").alias("max_installments"),
    )


def review_rollup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def order_metrics_joined(
    items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order metrics as two full outer joins of the rollups.

    The plain definition, kept to test ``order_metrics`` against: the coalesced
    key of the second join hides the partitioning, so everything moves again.
    """
    rolled = item_rollup(items).withColumnRenamed("order_id", "item_order")
    paid = payment_rollup(payments).withColumnRenamed("order_id", "paid_order")
    rated = review_rollup(reviews).withColumnRenamed("order_id", "rated_order")
    first_key = F.coalesce("item_order", "paid_order")
    return (
        rolled.join(paid, F.col("item_order") == F.col("paid_order"), "full_outer")
        .join(rated, first_key == F.col("rated_order"), "full_outer")
        .select(
            F.coalesce("item_order", "paid_order", "rated_order").alias("order_id"),
            _or_zero("items_count"),
            _or_zero("total_price"),
            _or_zero("total_freight"),
            _or_zero("total_payment"),
            _or_zero("max_installments"),
            "avg_review_score",
            _or_zero("review_count"),
        )
    )


def order_metrics(
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    known_orders_only: bool = False,
) -> DataFrame:
    """Order metrics in one shuffle and no join.

    The three inputs are stacked and grouped once. Map-side partial sums reduce
    an order with very many children to one row per task before the shuffle.
    Children without an order id stay one row per input, as the full outer joins
    leave them; ``known_orders_only`` drops them, for a join to orders, and the
    result is then partitioned by ``order_id`` alone.
    """
    one = F.lit(1)
    stacked = (
        items.select(
            "order_id",
            F.lit("item").alias("child"),
            one.alias("item"),
            "price",
            "freight_value",
        )
        .unionByName(
            payments.select(
                "order_id",
                F.lit("payment").alias("child"),
                "payment_value",
                "payment_installments",
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            reviews.select(
                "order_id", F.lit("review").alias("child"), one.alias("review"), "review_score"
            ),
            allowMissingColumns=True,
        )
    )
    if known_orders_only:
        keyed = stacked.filter(F.col("order_id").isNotNull()).groupBy("order_id")
    else:
        orphan = F.when(F.col("order_id").isNull(), F.col("child"))
        keyed = stacked.groupBy("order_id", orphan.alias("orphan"))
    return keyed.agg(
        F.count("item").alias("items_count"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight"),
        F.sum("payment_value").alias("total_payment"),
        F.max("payment_installments").alias("max_installments"),
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
        F.count("review").alias("review_count"),
    ).select(
        "order_id",
        "items_count",
        _or_zero("total_price"),
        _or_zero("total_freight"),
        _or_zero("total_payment"),
        _or_zero("max_installments"),
        "avg_review_score",
        "review_count",
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)
