"""The whole job: ingest, stage, model, publish, check."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import date_key
from starmart.operators.dimensions import dim_customer, dim_date, dim_product, dim_seller
from starmart.operators.facts import (
    fact_order_items,
    fact_orders,
    keyed_lines,
    keyed_orders,
    line_rows,
    order_rows,
)
from starmart.operators.rollups import order_metrics
from starmart.operators.skew import HotKeys, observe_hot_keys
from starmart.operators.staging import STAGED, stage_all
from starmart.plans.checks import CHECKS
from starmart.plans.layers import MARTS, STAGING, Places, Snapshot, Warehouse
from starmart.plans.quality import summarise
from starmart.sources import read_all_raw


def order_fact(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``fact_orders`` from staged tables. ``hot``: order ids that repeat very often, if known."""
    metrics = order_metrics(items, payments, reviews, known_orders_only=True)
    return fact_orders(orders, metrics, hot)


# Marts and the staged tables each reads. No mart reads another.
MODELS = {
    "fact_orders": (
        order_fact,
        ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews"),
    ),
    "fact_order_items": (fact_order_items, ("stg_order_items", "stg_orders")),
    "dim_customer": (dim_customer, ("stg_customers",)),
    "dim_product": (dim_product, ("stg_products",)),
    "dim_seller": (dim_seller, ("stg_sellers",)),
    "dim_date": (dim_date, ("stg_orders",)),
}

# Facts are laid out by purchase date, so that a month's report reads a month.
FACTS = ORDERS, ITEMS = "fact_orders", "fact_order_items"
DATE = "order_date_sk"
ROWS_PER_RANGE = 500_000

# More lines than these are joined and dealt out in several passes, each over its share of the
# order ids, so that only a share is in shuffles at a time.
LINES_PER_PASS = 2_000_000
MAX_PASSES = 4

# The order metrics stay a view among the marts; a catalog view needs SQL text.
ORDER_METRICS_VIEW = """
SELECT order_id,
       count(item) AS items_count,
       coalesce(sum(price), 0) AS total_price,
       coalesce(sum(freight_value), 0) AS total_freight,
       coalesce(sum(payment_value), 0) AS total_payment,
       coalesce(max(payment_installments), 0) AS max_installments,
       avg(CAST(review_score AS DOUBLE)) AS avg_review_score,
       count(review) AS review_count
FROM (SELECT order_id, 'item' AS child, 1 AS item, price, freight_value,
             NULL AS payment_value, NULL AS payment_installments,
             NULL AS review, NULL AS review_score
      FROM {staging}.stg_order_items
      UNION ALL
      SELECT order_id, 'payment', NULL, NULL, NULL, payment_value, payment_installments,
             NULL, NULL
      FROM {staging}.stg_order_payments
      UNION ALL
      SELECT order_id, 'review', NULL, NULL, NULL, NULL, NULL, 1, review_score
      FROM {staging}.stg_order_reviews)
GROUP BY order_id, if(order_id IS NULL, child, NULL)
"""


def model(
    staged: Mapping[str, DataFrame], hot: HotKeys | None = None
) -> dict[str, DataFrame]:
    """Dimensions and facts from staged tables; making the plans runs no job."""
    return {
        name: function(
            *[staged[source] for source in sources], *([hot] if function is order_fact else [])
        )
        for name, (function, sources) in MODELS.items()
    }


def read_staging_sources(
    warehouse: Warehouse,
    base: str,
    pattern: str = "{name}.csv",
    file_names: Mapping[str, str] | None = None,
    sep: str = ",",
) -> dict[str, DataFrame]:
    """The CSV extracts staging reads; a source no model uses may be absent."""
    names = [source for _, sources in STAGED.values() for source in sources]
    return read_all_raw(warehouse.spark, base, pattern, file_names, sep, names)


def build(
    warehouse: Warehouse,
    raw: Mapping[str, DataFrame],
    on_staged: Callable[[], None] | None = None,
) -> None:
    """Rebuild both layers from raw tables and publish them as one.

    Staged tables are written first: the text is parsed once instead of once per
    mart and check, and a lost executor re-reads columns rather than extracts.
    Order ids that repeat very often are noticed in passing. Facts are clustered by the
    order date, in ranges of equally many of their own rows: days are counted in the staged
    orders, and their lines in the written order fact. Rows are dealt out under natural keys and
    hashed behind that. ``on_staged`` is called once nothing reads the raw tables any more. Raises
    PublicationConflict if another build was published meanwhile.
    """
    parent = warehouse.newest()
    staged = stage_all(raw)
    staged["stg_orders"], hot_keys = observe_hot_keys(staged["stg_orders"], "order_id")
    staging = warehouse.write(STAGING, staged)
    if on_staged:
        on_staged()
    written = Snapshot(warehouse, {STAGING: staging}).read_layer(STAGING)
    tables = model(written)
    del tables[ITEMS]
    orders, items, payments, reviews = (written[name] for name in MODELS[ORDERS][1])
    day = date_key(F.col("order_purchase_timestamp"))
    places = Places.of(orders.groupBy(day).agg(F.count(F.lit(1))), DATE, ROWS_PER_RANGE)
    metrics = order_metrics(items, payments, reviews, known_orders_only=True)
    tables[ORDERS] = keyed_orders(places.deal(order_rows(orders, metrics, hot_keys())))
    marts = warehouse.write(MARTS, tables)

    fact = Snapshot(warehouse, {MARTS: marts}).read(MARTS, ORDERS)
    passes = min(MAX_PASSES, max(1, -(-items.count() // LINES_PER_PASS)))
    lines = []
    for number in range(passes):
        known, own, some = (_share(t, number, passes) for t in (fact, items, orders))
        by_day = known.groupBy(DATE).agg(F.sum("items_count"))
        # Smaller ranges by as much, since every pass has rows of every day.
        places = Places.of(by_day, DATE, -(-ROWS_PER_RANGE // passes), within=("order_id",))
        lines.append(keyed_lines(places.deal(line_rows(own, some))))
    marts = warehouse.write(MARTS, {ITEMS: lines}, build=marts)
    warehouse.publish({STAGING: staging, MARTS: marts}, parent)


def _share(table: DataFrame, number: int, passes: int) -> DataFrame:
    """The rows of every ``passes``-th order id, all rows of an id together."""
    if passes == 1:
        return table
    return table.filter(F.pmod(F.xxhash64("order_id"), F.lit(passes)) == number)


def mount(warehouse: Warehouse) -> None:
    """Make the published tables, and the order metrics view, queryable by name."""
    snapshot = warehouse.snapshot()
    staging, marts = (warehouse.mount(layer, snapshot) for layer in (STAGING, MARTS))
    view = ORDER_METRICS_VIEW.format(staging=f"`{staging}`")
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW `{marts}`.int_order_metrics AS {view}")


def query(warehouse: Warehouse, text: str) -> DataFrame:
    """SQL over one publication: ``{staging}`` and ``{marts}`` stand for its layers."""
    return warehouse.sql(text, {MARTS: {"int_order_metrics": ORDER_METRICS_VIEW}})


def published(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Every staged table and mart of one publication."""
    snapshot = warehouse.snapshot()
    return {**snapshot.read_layer(STAGING), **snapshot.read_layer(MARTS)}


def check(warehouse: Warehouse) -> DataFrame:
    """Result of every check on what is published."""
    return summarise(warehouse.spark, CHECKS, published(warehouse))


def run(warehouse: Warehouse, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Build, then check. A failing check reports bad marts; they stay published."""
    build(warehouse, raw)
    return check(warehouse)
