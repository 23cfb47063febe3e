
from __future__ import annotations

import atexit
import functools
import importlib
import importlib.util
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import oracles
from starmart.functions import (
    blank_to_null,
    date_key,
    date_spine,
    day_of_week,
    days_between,
    month_start,
    surrogate_key,
    to_double,
    to_int,
    to_timestamp,
)
from starmart.operators import dimensions, rollups, staging
from starmart.operators.facts import fact_orders
from starmart.plans import pipeline, quality, reports
from starmart.plans.checks import CHECKS
from starmart.plans.layers import MARTS, Warehouse, create_views
from starmart.sources import (
    RAW_SOURCES,
    adapters,
    read_all_raw,
    read_raw,
    remove_raw,
    write_raw,
)
from starmart.sources.raw_csv import read_stitched

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
MEANS = {"avg_review", "avg_delivery_days", "mean"}
# Not sums of many doubles: these come out the same in any order.
EXACT = {"price", "freight_value", "payment_value", "item_total", "avg_review_score"}


def rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles depend on the order of addition: compare at fixed digits."""
    return df.select(*[
        F.round(name, 6 if name in MEANS else 2).alias(name)
        if kind == "double" and name not in EXACT
        else F.col(name)
        for name, kind in df.dtypes
    ])


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names for checkpoints."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/starmart-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    """For one machine and no shared folder: a temporary one that ends with the process."""
    folder = tempfile.mkdtemp(prefix="starmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


# ---- tables -----------------------------------------------------------------


class Tables(Mapping):
    """Staged tables and marts over the given tables, each made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self._make(name)
        return self.made[name]

    def _make(self, name: str) -> DataFrame:
        if name in adapters.RAW_TABLES:
            return adapters.RAW_TABLES[name](self.spark, self.sf_dir)
        function, sources = (staging.STAGED.get(name) or pipeline.MODELS.get(name))
        return function(*[self[source] for source in sources])

    def __iter__(self) -> Iterator[str]:
        return iter([*staging.STAGED, *pipeline.MODELS])

    def __len__(self) -> int:
        return len(staging.STAGED) + len(pipeline.MODELS)


def _staged(name: str) -> Query:
    """A staged table from raw text, so that its casts do their work."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        function, sources = staging.STAGED[name]
        tables = Tables(spark, sf_dir)
        return function(*[adapters.as_text(tables[source]) for source in sources])

    return query


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: rounded(Tables(spark, sf_dir)[name])


def _children(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = Tables(spark, sf_dir)
    return t["stg_order_items"], t["stg_order_payments"], t["stg_order_reviews"]


def _date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = dimensions.date_bounds(Tables(spark, sf_dir)["stg_orders"])
    return date_spine(bounds, "min_date", "max_date", "date_day")


def _count_by(*columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = Tables(spark, sf_dir)["fact_orders"]
        return fact.groupBy(*columns).agg(F.count(F.lit(1)).alias("orders"))

    return query


# ---- reports and checks -----------------------------------------------------


def _report(report: Callable[..., DataFrame], *names: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        return rounded(report(*[tables[n] for n in names]))

    return query


def _check(check: quality.Check) -> Query:
    return lambda spark, sf_dir: rounded(quality.failures(check, Tables(spark, sf_dir)))


def _value_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order is a refund, so that the check has something to find."""
    tables = Tables(spark, sf_dir)
    refund = F.col("order_id").cast("bigint") % 7 == 0
    price = F.when(refund, -F.col("price")).otherwise(F.col("price"))
    tables.made["stg_order_items"] = tables["stg_order_items"].withColumn("price", price)
    check = next(c for c in CHECKS if c.kind == "singular")
    found = quality.failures(check, tables)
    return rounded(found.select("order_id", "total_order_value"))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(spark, CHECKS, Tables(spark, sf_dir))


def _mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks whose two sides have different types: text, doubles and integers."""
    number = F.col("l_linenumber")
    lines = adapters.load(spark, sf_dir, "lineitem").select(
        F.lpad((F.col("l_partkey") + number).cast("string"), 12, "0").alias("part"),
        (F.col("l_suppkey") + F.when(number == 7, 0.5).otherwise(0.0)).alias("supplier"),
        number.cast("double").alias("line"),
    )
    tables = {
        "lines": lines,
        "parts": adapters.load(spark, sf_dir, "part").select("p_partkey"),
        "suppliers": adapters.load(spark, sf_dir, "supplier").select("s_suppkey"),
    }
    checks = [
        quality.relationships("lines", "part", "parts", "p_partkey"),
        quality.relationships("lines", "supplier", "suppliers", "s_suppkey"),
        quality.accepted_values("lines", "line", [1, 2, "3"]),
        quality.unique("lines", "part"),
    ]
    return quality.summarise(spark, checks, tables)


# ---- sources, sinks and layers ----------------------------------------------


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    write_raw(adapters.as_text(adapters.orders(spark, sf_dir)), f"{base}/orders.csv")
    return read_raw(spark, base, "orders")


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews whose comments are whole documents, line breaks and quotes included."""
    nothing = F.lit(None).cast("string")
    reviews = adapters.load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
    )
    columns = RAW_SOURCES["order_reviews"].columns
    return reviews.select(*[c if c in reviews.columns else nothing.alias(c) for c in columns])


COMMENTS = ("review_id", "review_comment_title", "review_comment_message")


def _free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    write_raw(_reviews(spark, sf_dir), f"{base}/order_reviews.csv")
    return read_raw(spark, base, "order_reviews").select(*COMMENTS)


def _metrics_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline.mount(_published(spark, sf_dir))
    return rounded(spark.table("main_marts.int_order_metrics"))


def _staging_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged tables as session views, evaluated by the SQL that reads them."""
    tables = Tables(spark, sf_dir)
    create_views({name: tables[name] for name in ("stg_orders", "stg_order_payments")})
    return spark.sql(
        "SELECT payment_type, order_status, count(*) AS payments, "
        "round(sum(payment_value), 2) AS paid FROM stg_order_payments "
        "JOIN stg_orders USING (order_id) GROUP BY payment_type, order_status"
    )


def _dimension_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second build replaces every attribute of the first; no history is kept."""
    warehouse = Warehouse(spark, scratch(spark))
    customers = Tables(spark, sf_dir)["stg_customers"]
    moved = customers.withColumn("customer_city", F.lower("customer_city"))
    for version in (customers, moved):
        warehouse.refresh(MARTS, {"dim_customer": dimensions.dim_customer(version)})
    return warehouse.read(MARTS, "dim_customer")


def _stitched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from splits of 64 KB, far smaller than a file, that cut records anywhere."""
    base, name = scratch(spark), "spark.sql.files.maxPartitionBytes"
    write_raw(_reviews(spark, sf_dir), f"{base}/order_reviews.csv")
    before = spark.conf.get(name)
    spark.conf.set(name, "65536b")
    try:
        stitched = read_stitched(spark, f"{base}/order_reviews.csv").select(*COMMENTS)
        stitched.write.parquet(f"{base}/stitched")
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(stitched.schema).parquet(f"{base}/stitched")


def _published(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = Warehouse(spark, scratch(spark))
    pipeline.build(warehouse, adapters.raw_tables(spark, sf_dir))
    return warehouse


def _mart_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_published(spark, sf_dir).read(MARTS, "fact_order_items"))


def _summary_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.check(_published(spark, sf_dir))


def _csv_to_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine CSV extracts to published marts, queried by name in SQL.

    The extracts are scratch: they go once they are staged, before the marts take their place.
    """
    base = scratch(spark)
    extracts = f"{base}/raw"
    for name, table in adapters.raw_tables(spark, sf_dir).items():
        write_raw(adapters.as_text(table), f"{extracts}/{name}.csv")
    warehouse = Warehouse(spark, f"{base}/warehouse")
    raw = read_all_raw(spark, extracts)
    pipeline.build(warehouse, raw, on_staged=lambda: remove_raw(spark, extracts))
    pipeline.mount(warehouse)
    return spark.sql(
        "SELECT order_status, count(*) AS orders, round(sum(total_order_value), 2) AS revenue "
        "FROM main_marts.fact_orders GROUP BY order_status"
    )


# ---- single functions and operators over whole tables -----------------------


def _surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return adapters.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_key("o_orderkey").alias("key_one"),
        surrogate_key("o_orderkey", "o_orderstatus", "o_orderdate").alias("key_three"),
        surrogate_key(known, F.col("o_orderkey") % 2 == 0).alias("key_null_token"),
    )


def _text_and_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment, name = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_name")
    customers = adapters.load(spark, sf_dir, "customer").withColumn(
        "gappy", F.when(key % 4 == 0, F.lit("")).otherwise(segment)
    )
    return customers.select(
        key,
        F.upper(segment).alias("upper_segment"),
        F.concat_ws("||", name, F.when(key % 3 > 0, segment)).alias("joined_name"),
        F.md5(name).alias("name_md5"),
        blank_to_null(customers, "gappy").alias("filled_segment"),
        F.coalesce(
            F.when(key % 2 == 0, name), F.when(key % 3 == 0, segment), F.lit("none")
        ).alias("first_filled"),
    )


def _casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = adapters.load(spark, sf_dir, "lineitem").select(
        *keys,
        "l_shipdate",
        F.col("l_quantity").cast("string").alias("quantity"),
        (F.col("l_quantity") + 0.5).cast("string").alias("half"),
        F.col("l_shipdate").cast("string").alias("shipped"),
    )
    return lines.select(
        *keys,
        to_double(lines, "quantity").alias("text_to_double"),
        to_int(lines, "half").alias("text_to_int"),
        to_timestamp(lines, "shipped").alias("text_to_timestamp"),
        F.col("l_shipdate").cast("date").alias("timestamp_to_date"),
        F.col("l_linenumber").cast("double").alias("int_to_double"),
    )


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, day = F.col("ts"), F.col("ts").cast("date")
    later = F.timestamp_add("HOUR", (F.col("event_id") % 40).cast("int"), ts)
    return adapters.load(spark, sf_dir, "events").select(
        "event_id",
        date_key(ts).alias("date_key"),
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        days_between(ts, later).alias("days_between"),
        month_start(ts).alias("month_start"),
    )


def _conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searched case, comparisons and sums that meet NULL on some orders."""
    day, price = F.dayofweek(F.col("o_orderdate").cast("date")) - 1, F.col("o_totalprice")
    known = F.when(F.col("o_orderstatus") != "P", price)
    return adapters.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.isin(0, 6).alias("on_weekend"),
        (known <= 100000).alias("small"),
        known.isNull().alias("unknown"),
        F.when(known < 1000, "low").when(known > 100000, "high").otherwise("other").alias("band"),
        (known + F.lit(1.5)).alias("raised"),
        ((price >= 5000) & (known <= 100000)).alias("both"),
        ((price >= 5000) | (known <= 100000)).alias("either"),
    )


def _null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs come last; the position makes the order of the three groups part of the result."""
    groups = (
        _conditions(spark, sf_dir).groupBy("small").agg(F.count(F.lit(1)).alias("orders"))
    )
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("small")))
    return groups.select((place - 1).cast("bigint").alias("position"), "small", "orders")


def _aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.load(spark, sf_dir, "events")
    return rounded(
        events.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("user_id").alias("users"),
            F.sum("value").alias("total"),
            F.avg("value").alias("mean"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


def _join_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of join with its rows and the sums of both sides' keys, NULL where unmatched."""
    items, payments, reviews = _children(spark, sf_dir)
    orders = Tables(spark, sf_dir)["stg_orders"]

    def keys(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("order_id").alias(name))

    rolled = keys(rollups.item_rollup(items), "a")
    paid = keys(rollups.payment_rollup(payments), "b")
    rated = keys(rollups.review_rollup(reviews), "c")
    both = rolled.join(paid, F.col("a") == F.col("b"), "full_outer")
    either = both.select(F.coalesce("a", "b").alias("a"))
    equal = F.col("a") == F.col("b")
    joined = {
        "inner": keys(items, "a").join(keys(orders, "b"), equal),
        "left": keys(orders, "a").join(keys(payments, "b"), equal, "left"),
        "full_outer": both,
        "full_outer_on_expression": either.join(
            rated, F.col("a") == F.col("c"), "full_outer"
        ).select("a", F.col("c").alias("b")),
        "anti": keys(payments, "a").join(keys(orders, "b"), equal, "left_anti").withColumn(
            "b", F.lit(None).cast("string")
        ),
    }
    result = None
    for name, df in joined.items():
        counted = df.agg(
            F.lit(name).alias("join_type"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("a").cast("bigint")).alias("left_keys"),
            F.sum(F.col("b").cast("bigint")).alias("right_keys"),
        )
        result = counted if result is None else result.unionAll(counted)
    return result


def _optional(name: str):
    """A module of the training-data part, or None where that part is not installed."""
    package = name.rpartition(".")[0]
    for part in (package, name):
        spec = importlib.util.find_spec(part) if part else None
        if part and (spec is None or spec.origin is None):
            return None
    return importlib.import_module(name)


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by month over the smoke tables, from raw tables to the report."""
    return queries()["rpt_monthly_revenue"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """Every operator of the inventory that yields a table, by name."""
    found: dict[str, Query] = {}
    for name in (
        "stg_customers",
        "stg_orders",
        "stg_order_items",
        "stg_order_payments",
        "stg_order_reviews",
        "stg_products",
        "stg_sellers",
    ):
        found[name] = _staged(name)

    found["int_items"] = lambda s, d: rounded(rollups.item_rollup(_children(s, d)[0]))
    found["int_payments"] = lambda s, d: rounded(rollups.payment_rollup(_children(s, d)[1]))
    found["int_reviews"] = lambda s, d: rounded(rollups.review_rollup(_children(s, d)[2]))
    found["order_metrics"] = lambda s, d: rounded(rollups.order_metrics(*_children(s, d)))
    found["order_metrics_joined"] = lambda s, d: rounded(
        rollups.order_metrics_joined(*_children(s, d))
    )

    for name in (
        "dim_customer",
        "dim_product",
        "dim_seller",
        "dim_date",
        "fact_orders",
        "fact_order_items",
    ):
        found[name] = _mart(name)
    found["date_bounds"] = lambda s, d: dimensions.date_bounds(Tables(s, d)["stg_orders"])
    found["date_spine"] = _date_spine
    found["delivery_days"] = _count_by("delivery_days")
    found["on_time_flag"] = _count_by("order_status", "delivered_on_time")

    found["rpt_kpis"] = _report(reports.delivered_kpis, "fact_orders")
    found["rpt_monthly_revenue"] = _report(reports.monthly_revenue, "fact_orders")
    found["rpt_top_categories"] = _report(
        reports.top_categories, "fact_order_items", "dim_product"
    )
    found["rpt_state_revenue"] = _report(reports.state_revenue, "fact_orders", "dim_customer")
    found["rpt_installments"] = _report(reports.installment_distribution, "fact_orders")
    found["rpt_top_sellers"] = _report(reports.top_sellers, "fact_order_items", "dim_seller")
    found["rpt_status"] = _report(reports.status_summary, "fact_orders")

    found["dq_not_null"] = _check(quality.not_null("fact_orders", "total_order_value"))
    found["dq_unique"] = _check(quality.unique("fact_order_items", "order_item_sk"))
    found["dq_accepted_values"] = _check(
        quality.accepted_values("stg_orders", "order_status", ["delivered", "shipped"])
    )
    found["dq_relationships"] = _check(
        quality.relationships("stg_order_payments", "order_id", "stg_orders", "order_id")
    )
    found["dq_value_non_negative"] = _value_non_negative
    found["dq_mixed_types"] = _mixed_types
    found["dq_summary"] = _summary
    found["dq_summary_published"] = _summary_published

    found["raw_csv_scan"] = _csv_scan
    found["raw_csv_free_text"] = _free_text
    found["raw_csv_stitched"] = _stitched
    found["staging_views"] = _staging_views
    found["mart_read_back"] = _mart_read_back
    found["dimension_overwrite"] = _dimension_overwrite
    found["order_metrics_view"] = _metrics_view
    found["csv_to_catalog"] = _csv_to_catalog

    found["surrogate_key"] = _surrogate_key
    found["fn_text_and_null"] = _text_and_null
    found["fn_casts"] = _casts
    found["fn_dates"] = _dates
    found["fn_conditions"] = _conditions
    found["fn_aggregates"] = _aggregates
    found["rel_null_order"] = _null_order
    found["rel_join_types"] = _join_types
    if operators := _optional("starmart.llm.queries"):
        found |= operators.queries()
    if corpus := _optional("corpus_pipeline"):
        found["pipeline"] = corpus.run
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    if operators := _optional("starmart.llm.queries"):
        found |= operators.oracle_sql()
    if (corpus := _optional("corpus_pipeline")) and corpus.ORACLE_SQL:
        found["pipeline"] = corpus.ORACLE_SQL
    return found
