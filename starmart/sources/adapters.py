"""Raw-shaped tables made from the benchmark's Parquet tables.

Each adapter is a projection of one table (customers and sellers also look up
their nation), so the queries over them scale as the given tables do. Columns
arrive typed; ``as_text`` turns them into what a CSV extract would hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE = {
    "view": "credit_card",
    "click": "boleto",
    "purchase": "debit_card",
    "signup": "voucher",
    "error": "not_defined",
}
# MEDIUM has no translation.
TRANSLATION = {
    "ECONOMY": "economy",
    "STANDARD": "standard",
    "LARGE": "large",
    "PROMO": "promo",
    "SMALL": "small",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    purchased = _later("HOUR", key % 24, F.col("o_orderdate"))
    approved = _later("HOUR", 1 + key % 48, purchased)
    sent = F.col("o_orderstatus").isin("F", "O")
    delivered = _later("HOUR", (key % 31) * 24 + key % 17, purchased)
    estimated = _later("DAY", 10 + key % 7, purchased)
    return load(spark, sf_dir, "orders").select(
        _text(key).alias("order_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        _recode(F.col("o_orderstatus"), STATUS).alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        F.when(sent, _later("DAY", 1 + key % 5, approved)).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", delivered).alias("order_delivered_customer_date"),
        F.when(key % 50 != 0, estimated).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers repeat within some orders and are kept as they are.

    Renumbering them would sort all lines of an order in one task.
    """
    return load(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text(F.col("l_partkey")).alias("product_id"),
        _text(F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return load(spark, sf_dir, "events").select(
        _text((event - event % 2) * 2).alias("order_id"),
        (1 + event % 2).cast("int").alias("payment_sequential"),
        _recode(F.col("event_type"), PAYMENT_TYPE).alias("payment_type"),
        (1 + event % 10).cast("int").alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some titles and messages are blank, some answers missing, so that cleaning has work."""
    key = F.col("doc_id")
    created = _later("HOUR", key, F.lit("2017-01-01 06:30:00").cast("timestamp_ntz"))
    title = F.concat(F.lit("Review "), _text(key))
    message = F.concat(F.lit('said "ok",\nscore '), _text(key % 5))
    return load(spark, sf_dir, "labels").select(
        _text(key).alias("review_id"),
        _text(key * 15).alias("order_id"),
        (1 + F.col("quality") * 3 + F.col("toxic")).alias("review_score"),
        F.when(key % 4 == 0, "").otherwise(title).alias("review_comment_title"),
        F.when(key % 3 == 0, "").otherwise(message).alias("review_comment_message"),
        created.alias("review_creation_date"),
        F.when(key % 5 != 0, _later("DAY", 1 + key % 9, created)).alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing, size = F.lit(None).cast("int"), F.col("p_size").cast("int")
    return load(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        nothing.alias("product_name_lenght"),
        nothing.alias("product_description_lenght"),
        (size % 7).alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        F.when(size % 3 != 0, size * 2).alias("product_height_cm"),
        (50 - size).alias("product_width_cm"),
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same few rows at every scale, as the category list is."""
    rows = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATION.items())
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)"
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = load(spark, sf_dir, "nation")
    return load(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        _text(F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.lower("n_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = load(spark, sf_dir, "nation")
    return load(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        _text(F.col("s_suppkey")).alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.lower("n_name").alias("seller_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations stand in for places; nothing downstream reads them."""
    key = F.col("n_nationkey").cast("double")
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("geolocation_zip_code_prefix"),
        (key / 2).alias("geolocation_lat"),
        (-key / 4).alias("geolocation_lng"),
        F.lower("n_name").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


RAW_TABLES = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "product_category_name_translation": translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine raw sources by name."""
    return {name: table(spark, sf_dir) for name, table in RAW_TABLES.items()}


def _text(key: Column) -> Column:
    return key.cast(T.LongType()).cast("string")


def _later(unit: str, amount: Column, moment: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), moment)


def _recode(code: Column, names: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for value, name in names.items():
        result = F.when(code == value, F.lit(name)).otherwise(result)
    return result
