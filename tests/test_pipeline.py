"""Building, publishing, mounting and checking a whole warehouse."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest

import __spark_entry__ as entry_point
from starmart import __main__ as command_line
from starmart.operators.staging import stage_all
from starmart.plans import pipeline
from starmart.plans.layers import (
    MARTS, STAGING, Build, PublicationConflict, Warehouse, create_views,
)
from tests.conftest import failing
from tests.fixtures import CSV, write_sources


def raw(warehouse, folder, **replaced):
    return pipeline.read_staging_sources(warehouse, write_sources(folder, **replaced))


def rows(df):
    return sorted(map(str, df.collect()))


def test_published_tables_equal_the_lazy_ones(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    sources = raw(warehouse, tmp_path)
    pipeline.build(warehouse, sources)
    staged = stage_all(sources)
    expected = {**staged, **pipeline.model(staged)}
    published = {**warehouse.read_layer(STAGING), **warehouse.read_layer(MARTS)}
    assert set(published) == set(expected) and len(published) == 13
    for name, table in published.items():
        assert table.dtypes == expected[name].dtypes
        assert rows(table) == rows(expected[name]), name


def test_checks_find_what_is_wrong_with_the_small_orders(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    result = pipeline.run(warehouse, raw(warehouse, tmp_path))
    assert result.count() == 64
    failed = {row.test: row.failures for row in result.collect() if not row.passed}
    assert failed == {
        "accepted_values_stg_orders_order_status": 1,
        "accepted_values_stg_order_payments_payment_type": 1,
        "accepted_values_stg_order_reviews_review_score": 1,
        "relationships_stg_orders_customer_id__stg_customers_customer_id": 1,
        "relationships_stg_order_items_order_id__stg_orders_order_id": 1,
        "relationships_fact_orders_customer_sk__dim_customer_customer_sk": 1,
        "relationships_fact_order_items_customer_sk__dim_customer_customer_sk": 1,
        "not_null_fact_orders_total_order_value": 1,
        "fact_orders_value_not_negative": 1,
    }


def test_rebuild_replaces_and_old_readers_keep_their_version(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    pipeline.build(warehouse, raw(warehouse, tmp_path))
    before = warehouse.read(MARTS, "dim_seller")
    sellers = CSV["sellers"].replace("campinas", "santos") + "s3,5,natal,rn\n"
    pipeline.build(warehouse, raw(warehouse, tmp_path, sellers=sellers))
    assert before.count() == 2
    after = warehouse.read(MARTS, "dim_seller")
    assert {(r.seller_id, r.seller_city) for r in after.collect()} == {
        ("s1", "santos"), ("s2", "olinda"), ("s3", "natal")
    }


def test_extracts_are_kept_until_staged_and_no_longer(spark, tmp_path, monkeypatch):
    """The registered query leaves its marts and no extract; one that is never staged stays."""
    monkeypatch.setattr(entry_point, "scratch", lambda spark: f"file://{tmp_path}/query")
    found = entry_point.queries()["csv_to_catalog"](spark, "/root/testdata/sf0.001")
    assert {p.name for p in (tmp_path / "query").iterdir()} == {"warehouse"}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert sum(row.orders for row in found.collect()) == orders > 0
    calls = []
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    broken = CSV["order_items"].replace("10.50", "ten")
    with failing("cannot read 'ten' as double"):
        pipeline.build(
            warehouse, raw(warehouse, tmp_path, order_items=broken), lambda: calls.append(1)
        )
    assert calls == []


def test_failed_build_leaves_the_published_one(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    pipeline.build(warehouse, raw(warehouse, tmp_path))
    broken = CSV["order_items"].replace("10.50", "ten")
    with failing("cannot read 'ten' as double"):
        pipeline.build(warehouse, raw(warehouse, tmp_path, order_items=broken))
    assert warehouse.read(STAGING, "stg_order_items").count() == 5


def test_pruning_keeps_the_newest_builds(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    versions = [warehouse.refresh(MARTS, {"t": spark.range(n)}) for n in (1, 2)]
    with pytest.raises(Exception):
        warehouse.refresh(MARTS, {"t": spark.range(1).selectExpr("raise_error('no') AS x")})
    failed = [p.name for p in (tmp_path / "wh" / MARTS).iterdir() if p.name not in versions]
    versions += [warehouse.refresh(MARTS, {"t": spark.range(n)}) for n in (3, 4)]
    other = warehouse.refresh(STAGING, {"t": spark.range(9)})
    assert len(failed) == 1
    before = warehouse.read(MARTS, "t")
    # What was never published may be a build that runs, until it is old enough.
    assert warehouse.prune(MARTS, keep=2) == versions[:2]
    assert warehouse.prune(MARTS, keep=2, running=timedelta(0)) == failed
    assert before.count() == 4 and warehouse.read(MARTS, "t").count() == 4
    assert {p.name for p in (tmp_path / "wh" / MARTS).iterdir()} == set(versions[2:])
    assert [p.name for p in (tmp_path / "wh" / STAGING).iterdir()] == [other]
    with pytest.raises(ValueError):
        warehouse.prune(MARTS, keep=0)


def test_one_reader_sees_one_build_of_all_layers(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    pipeline.build(warehouse, raw(warehouse, tmp_path))
    reader = warehouse.snapshot()
    first = reader.read(STAGING, "stg_sellers").count()
    more = CSV["sellers"] + "s3,5,natal,rn\n"
    pipeline.build(warehouse, raw(warehouse, tmp_path, sellers=more))
    assert reader.read(MARTS, "dim_seller").count() == first == 2
    assert warehouse.snapshot().read(MARTS, "dim_seller").count() == 3
    # A build that stops between the layers changes neither.
    warehouse.write(STAGING, {"stg_sellers": spark.range(9)})
    assert {t.count() for t in (warehouse.read(STAGING, "stg_sellers"),
                                warehouse.read(MARTS, "dim_seller"))} == {3}


def test_of_two_builds_at_once_one_is_published(spark, tmp_path, monkeypatch):
    """Both begin from the same publication; the loser hears of it and nothing is mixed."""
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    pipeline.build(warehouse, raw(warehouse, tmp_path))
    first = warehouse.newest()
    both = threading.Barrier(2)
    publish = Warehouse.publish

    def together(self, *arguments, **options):
        both.wait(60)
        return publish(self, *arguments, **options)

    monkeypatch.setattr(Warehouse, "publish", together)
    folders = [tmp_path / "a", tmp_path / "b"]
    sources = []
    for n, folder in enumerate(folders):
        folder.mkdir()
        more = CSV["sellers"] + "".join(f"s{k},5,natal,rn\n" for k in range(3, 4 + n))
        sources.append(raw(warehouse, folder, sellers=more))
    outcomes = []

    def build(source):
        try:
            pipeline.build(Warehouse(spark, f"{tmp_path}/wh"), source)
            outcomes.append("published")
        except PublicationConflict as conflict:
            outcomes.append("conflict")
            assert f"publication {first.number + 1} replaced" in str(conflict)

    threads = [threading.Thread(target=build, args=(s,)) for s in sources]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(outcomes) == ["conflict", "published"]
    assert warehouse.newest().number == first.number + 1
    after = warehouse.snapshot()
    assert after.read(MARTS, "dim_seller").count() == after.read(STAGING, "stg_sellers").count() in (3, 4)


def test_entries_are_created_once_each(spark, tmp_path):
    """Many publications at the same instant: every number is taken once, none is lost."""
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    layers = {f"layer{n}": Build(f"v{n}", {}) for n in range(12)}
    with ThreadPoolExecutor(12) as pool:
        list(pool.map(lambda item: warehouse.publish(dict([item])), layers.items()))
    newest = warehouse.newest()
    assert newest.number == 12 and newest.layers == layers
    names = sorted(p.name for p in (tmp_path / "wh/publications").iterdir() if p.suffix == ".json")
    assert names == [f"{n:012d}.json" for n in range(1, 13)]


def test_a_build_that_read_a_replaced_layer_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    warehouse.refresh(STAGING, {"t": spark.range(1)})
    parent = warehouse.newest()
    marts = warehouse.write(MARTS, {"t": spark.range(2)})
    warehouse.refresh("other", {"t": spark.range(3)})
    warehouse.publish({MARTS: marts}, parent, reads=[STAGING])
    warehouse.refresh(STAGING, {"t": spark.range(4)})
    with pytest.raises(PublicationConflict, match="staging"):
        warehouse.publish({"third": marts}, parent, reads=[STAGING])
    with pytest.raises(PublicationConflict, match="marts"):
        warehouse.publish({MARTS: marts}, parent)
    assert set(warehouse.newest().layers) == {STAGING, MARTS, "other"}


def test_an_entry_is_never_seen_half_written(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    warehouse.publish({"l": Build("v1", {})})
    (tmp_path / "wh/publications/_draft").write_text("{")
    assert warehouse.newest().number == 1 and warehouse.prune("none") == []


def test_reading_what_is_not_there(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    with pytest.raises(Exception):
        warehouse.read(MARTS, "fact_orders")
    warehouse.refresh(STAGING, {"one": spark.range(1)})
    with pytest.raises(LookupError):
        warehouse.read(MARTS, "fact_orders")
    with pytest.raises(KeyError):
        warehouse.read(STAGING, "two")


def test_mounted_names_answer_sql(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh", prefix="shop_")
    sources = raw(warehouse, tmp_path)
    pipeline.build(warehouse, sources)
    pipeline.mount(warehouse)
    by_status = spark.sql(
        "select order_status, count(*), sum(total_order_value) from shop_marts.fact_orders group by 1"
    )
    assert {tuple(r) for r in by_status.collect()} == {
        ("delivered", 2, 29.75), ("canceled", 1, None), ("shipped", 1, 0.0), ("lost", 1, 7.5)
    }
    staged = stage_all(sources)
    metrics = pipeline.order_metrics(
        staged["stg_order_items"], staged["stg_order_payments"], staged["stg_order_reviews"]
    )
    view = spark.table("shop_marts.int_order_metrics")
    assert view.dtypes == metrics.dtypes
    assert rows(view) == rows(metrics)
    months = spark.sql(
        "select date_trunc('month', order_purchase_timestamp) as month, count(*) "
        "from shop_marts.fact_orders group by 1 order by 1"
    )
    assert [r[1] for r in months.collect()] == [1, 4]
    # A second build moves the mounted names once they are mounted again.
    pipeline.build(warehouse, raw(warehouse, tmp_path, sellers=CSV["sellers"] + "s3,5,natal,rn\n"))
    assert spark.table("shop_staging.stg_sellers").count() == 2
    pipeline.mount(warehouse)
    assert spark.table("shop_staging.stg_sellers").count() == 3


def test_a_reader_never_mixes_builds(spark, tmp_path):
    """SQL over both layers while builds are published and old ones pruned: always of one build."""
    warehouse = Warehouse(spark, f"{tmp_path}/wh", prefix="atomic_")
    pipeline.build(warehouse, raw(warehouse, tmp_path))
    text = """SELECT (SELECT count(*) FROM {staging}.stg_sellers) AS staged,
                     (SELECT count(*) FROM {marts}.dim_seller) AS built,
                     (SELECT count(DISTINCT seller_city) FROM {staging}.stg_sellers WHERE seller_city LIKE 'city%') AS cities"""
    seen, failed, stop = [], [], threading.Event()

    def read():
        reader = Warehouse(spark, f"{tmp_path}/wh", prefix="atomic_")
        try:
            while not stop.is_set():
                seen.append(tuple(pipeline.query(reader, text).first()))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    thread = threading.Thread(target=read)
    thread.start()
    for n in range(1, 4):
        folder = tmp_path / str(n)
        folder.mkdir()
        sellers = CSV["sellers"] + "".join(f"x{k},5,city{n},rn\n" for k in range(n))
        pipeline.build(warehouse, raw(warehouse, folder, sellers=sellers))
    last = len(seen)
    while len(seen) < last + 2 and thread.is_alive():
        stop.wait(0.1)
    stop.set()
    thread.join()
    assert not failed
    assert {(s, b) for s, b, _ in seen} <= {(2 + n, 2 + n) for n in range(4)}
    assert seen[0] == (2, 2, 0) and seen[-1] == (5, 5, 1) and len(set(seen)) >= 2
    metrics = pipeline.query(warehouse, "SELECT * FROM {marts}.int_order_metrics")
    staged = warehouse.read_layer(STAGING)
    assert rows(metrics) == rows(pipeline.order_metrics(
        staged["stg_order_items"], staged["stg_order_payments"], staged["stg_order_reviews"]))
    gone = warehouse.prune(MARTS, keep=1)
    left = [d.name for d in spark.catalog.listDatabases("atomic_marts*")]
    assert len(gone) == 3 and left == [warehouse._database(MARTS, warehouse.newest().version(MARTS))]


def test_reports_are_printed_in_full(spark, capsys):
    command_line.show(spark.range(1500).orderBy("id"), None)
    assert capsys.readouterr().out.splitlines() == ["id", *map(str, range(1500))]


def test_views_are_evaluated_when_read(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    create_views(stage_all(raw(warehouse, tmp_path)))
    assert spark.sql("select upper(seller_city) from stg_sellers where seller_id = 's1'").first()[
        0
    ] == "CAMPINAS"


def test_command_line(spark, tmp_path, capsys):
    base, root = write_sources(tmp_path), f"{tmp_path}/wh"
    (tmp_path / "sellers.csv").rename(tmp_path / "shops.csv")
    options = ["--warehouse", root]
    build = ["build", "--raw", base, "--file", "sellers=shops.csv", *options]
    assert command_line.main(build, spark) == 0
    assert command_line.main(["check", *options], spark) == 1
    printed = capsys.readouterr().out
    assert printed.count("PASS") == 55 and "FAIL 1 relationships_stg_orders_customer_id" in printed
    for name in command_line.REPORTS:
        assert command_line.main(["report", name, *options], spark) == 0
    assert "toys" in capsys.readouterr().out
    assert spark.table("main_marts.fact_orders").count() == 5
    assert command_line.main(["mount", *options], spark) == 0
    counted = "select count(*) as n from {marts}.fact_orders join {staging}.stg_orders using (order_id)"
    assert command_line.main(["sql", counted, *options], spark) == 0
    assert capsys.readouterr().out.splitlines()[-2:] == ["n", "5"]
    orphans = ["check", "--rows", "relationships_stg_orders_customer_id__stg_customers_customer_id"]
    assert command_line.main([*orphans, *options], spark) == 0
    assert capsys.readouterr().out.splitlines()[0] == "from_field"
    kept = f"{tmp_path}/report"
    assert command_line.main(["report", "status", "--output", kept, *options], spark) == 0
    assert spark.read.option("header", True).csv(kept).count() == 4
    assert command_line.main(build, spark) == 0
    assert command_line.main(["prune", "--keep", "1", *options], spark) == 0
    assert capsys.readouterr().out.count("deleted") == 2
