from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators.relational import align, first_rows, latest_per_key
from tradewind.plans import loads
from tradewind.sources import schemas

DDL = "ID string, title string, updated_at string, bogus string"


def products(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], DDL)


def test_declared_tables():
    assert len(schemas.STAGING) == 18
    assert sum(len(schemas.columns(t)) for t in schemas.STAGING) == 234
    assert len(schemas.WAREHOUSE) == 12


def test_align(spark, caplog):
    out = align(products(spark, ("p1", "A", "2001-01-01")), "stg_products")
    assert out.columns == [n for n, _ in schemas.columns("stg_products")]
    assert "bogus" in caplog.text
    row = out.first()
    assert row.id == "p1" and row.handle is None and row.updated_at == datetime(2001, 1, 1)
    nan = spark.sql("select 'v' id, double('NaN') price")
    assert align(nan, "stg_product_variants").first().price is None


def test_full_load_replaces_and_appends(spark, store):
    df = products(spark, ("p1", "A", "2001-01-01"), ("p2", None, None))
    assert store.load_full("stg_products", df) == 2
    assert store.load_full("stg_products", df) == 2 and store.count("stg_products") == 2
    store.load_full("stg_products", df, truncate=False)
    assert store.count("stg_products") == 4


def failing(spark, n):
    rows = products(spark, *[(f"p{i}", "T", "2001-01-01") for i in range(n)])
    return rows.withColumn("title", F.when(F.col("ID") == "p3", F.raise_error(F.lit("no"))).otherwise(F.col("title")))


def test_failed_loads_can_be_repeated(spark, store):
    good = products(spark, ("p1", "A", "2001-01-01"), ("p2", "B", "2001-01-01"))
    for before in (0, 2):
        with pytest.raises(Exception, match="no"):
            store.load_full("stg_products", failing(spark, 5))
        with pytest.raises(Exception, match="no"):
            store.upsert("stg_products", failing(spark, 5))
        assert (store.count("stg_products") if before else store.exists("stg_products")) == before
        store.load_full("stg_products", good)
    assert store.count("stg_products") == 2
    assert [t.name for t in store.spark.catalog.listTables(store.database)] == ["stg_products"]  # no stage is left


def files(store, table):
    """The data files by partition."""
    out = {}
    for f in sorted(store.spark.table(store.name(table)).inputFiles()):
        out.setdefault(f.split("/")[-2], []).append(f.split("/")[-1])
    return out


def test_upsert_leaves_other_buckets_alone(spark, store):
    store.load_full("stg_products", products(spark, *[(f"p{i}", "A", "2001-01-01") for i in range(200)]))
    store.upsert("stg_products", products(spark, ("p1", "B", "2001-02-01")))
    first = files(store, "stg_products")
    store.upsert("stg_products", products(spark, ("p1", "C", "2001-03-01")))
    second = files(store, "stg_products")
    assert first.keys() == second.keys() and sum(first[k] != second[k] for k in first) == 1
    assert store.count("stg_products") == 200
    assert [r.title for r in store.read("stg_products").filter("id = 'p1'").collect()] == ["C"]


def test_an_upsert_that_fails_at_the_overwrite_can_be_repeated(spark, store, monkeypatch):
    store.load_full("stg_products", products(spark, *[(f"p{i}", "A", "2001-01-01") for i in range(50)]))
    batch = products(spark, *[(f"p{i}", "B", "2001-02-01") for i in range(40, 60)])
    overwrite = type(store)._overwrite

    def broken(self, table, df):
        overwrite(self, table, df.withColumn("title", F.when(F.col("id") == "p47", F.raise_error(F.lit("lost"))).otherwise(F.col("title"))))

    with monkeypatch.context() as m:
        m.setattr(type(store), "_overwrite", broken)
        with pytest.raises(Exception, match="lost"):
            store.upsert("stg_products", batch)
    assert store.count("stg_products") == 50 and store.read("stg_products").filter("title = 'B'").isEmpty()
    store.upsert("stg_products", batch)
    assert store.count("stg_products") == 60 and store.read("stg_products").filter("title = 'B'").count() == 20


def test_a_full_load_drops_buckets_it_has_no_rows_for(spark, store):
    store.load_full("stg_products", products(spark, *[(f"p{i}", "A", "2001-01-01") for i in range(50)]))
    store.load_full("stg_products", products(spark, ("p1", "B", None)))
    assert [r.title for r in store.read("stg_products").collect()] == ["B"] and len(store.partitions("stg_products")) == 1
    store.load_full("stg_products", products(spark, ("p1", "B", None)).limit(0))
    assert store.count("stg_products") == 0 and store.exists("stg_products")


def test_children_of_changed_parents_are_replaced(spark, store):
    ddl = "order_id string, line_number int, title string"
    taxes = lambda *rows: spark.createDataFrame(rows, ddl)
    store.load_full("stg_order_tax_lines", taxes(*[(f"o{i}", n, "A") for i in range(30) for n in (1, 2, 3)]))
    changed = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o99",)], "id string")
    for _ in range(2):  # o1 keeps one tax, o2 none, o3 is as before
        store.replace_children("stg_order_tax_lines", taxes(("o1", 1, "B"), ("o3", 1, "A"), ("o3", 2, "A"), ("o3", 3, "A"), ("o99", 1, "N")), changed)
    left = {r.order_id: r["count"] for r in store.read("stg_order_tax_lines").groupBy("order_id").count().collect()}
    assert left == {**{f"o{i}": 3 for i in range(30) if i not in (1, 2)}, "o1": 1, "o99": 1}
    only = spark.createDataFrame([(f"o{i}",) for i in range(100)], "id string")
    store.replace_children("stg_order_tax_lines", taxes(("o5", 1, "C")), only)  # most buckets lose all rows
    assert [tuple(r)[:2] for r in store.read("stg_order_tax_lines").select("order_id", "title").collect()] == [("o5", "C")]


def test_retention_drops_folders_or_retires_them(spark, store):
    import os

    levels = spark.sql("select 'i' || id inventory_item_id, 'l' location_id, cast(id as int) available, date_add(date'2001-01-01', cast(id % 5 as int)) snapshot_date from range(30)")
    store.upsert_partitions("stg_inventory_levels", levels, "snapshot_date")
    old = lambda limit: lambda day: day < limit
    assert store.retain("stg_inventory_levels", old("2001-01-03"), soft=True) == ["2001-01-01", "2001-01-02"]
    assert store.count("stg_inventory_levels") == 18 and len(store.partitions("stg_inventory_levels")) == 5
    store.restore("stg_inventory_levels")
    assert store.count("stg_inventory_levels") == 30
    store.retain("stg_inventory_levels", old("2001-01-03"))
    folders = sorted(n for n in os.listdir(f"{store.root}/stg_inventory_levels") if n.startswith("snapshot_date="))
    assert folders == ["snapshot_date=2001-01-03", "snapshot_date=2001-01-04", "snapshot_date=2001-01-05"]
    assert store.count("stg_inventory_levels") == 18
    store.create_if_absent("etl_marks")
    with pytest.raises(ValueError):
        store.retain("etl_marks", old("x"))


def test_snapshot_days_are_pruned(spark, store):
    levels = spark.sql("select 'i' || id inventory_item_id, 'l' location_id, cast(id as int) available, date_add(date'2001-01-01', cast(id % 3 as int)) snapshot_date from range(30)")
    store.upsert_partitions("stg_inventory_levels", levels, "snapshot_date")
    day = store.read("stg_inventory_levels").filter("snapshot_date = date'2001-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and day.count() == 10
    before = files(store, "stg_inventory_levels")
    store.upsert_partitions("stg_inventory_levels", levels.filter("snapshot_date = date'2001-01-03'"), "snapshot_date")
    after = files(store, "stg_inventory_levels")
    assert sum(before[k] != after[k] for k in before) == 1 and store.count("stg_inventory_levels") == 30


def test_missing_and_created_tables(store):
    with pytest.raises(LookupError):
        store.columns("stg_products")
    assert store.create_if_absent("stg_products") and not store.create_if_absent("stg_products")
    assert store.count("stg_products") == 0


def test_upsert(spark, store):
    store.load_full("stg_products", products(spark, ("p1", "A", "2001-01-01"), ("p2", "B", "2001-01-01"), (None, "N", None)))
    batch = products(
        spark, ("p1", "A1", "2001-02-01"), ("p1", "A2", "2001-03-01"), ("p3", "C", "2001-01-01"), (None, "N", None)
    )
    for _ in range(2):  # a NULL key never matches, so only that row is added again
        store.upsert("stg_products", batch)
    rows = sorted((r.id or "", r.title) for r in store.read("stg_products").collect())
    assert rows == [("", "N"), ("", "N"), ("", "N"), ("p1", "A2"), ("p2", "B"), ("p3", "C")]
    assert store.upsert("stg_products", batch.limit(0)) == 0


def test_latest_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 2)], "k string, v int")
    assert latest_per_key(df, ["k"], [F.desc("v")]).count() == 3


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    ranked = first_rows(spark.range(1000).withColumn("g", F.col("id") % 1), ["g"], [F.col("id")], 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r.id for r in ranked.orderBy("id").collect()] == [0, 1, 2]


def test_modes(spark, store):
    with pytest.raises(ValueError):
        loads.resolve_mode(store, "stg_orders", "sometimes")
    assert loads.resolve_mode(store, "stg_products", "auto") == "full"
    store.load_full("stg_products", products(spark, ("p1", "A", "2001-01-01")))
    assert loads.resolve_mode(store, "stg_products", "auto") == "incremental"
    assert loads.high_water_mark(store, "stg_products") == datetime(2001, 1, 1)
    assert loads.high_water_mark(store, "stg_orders") is None


def test_entity_loads_record_their_state(spark, store):
    from tradewind.sources import documents

    run = datetime(2001, 1, 1)
    docs = spark.createDataFrame([], documents.LOCATION)
    assert [r.rows for r in loads.load_entities(store, {"stg_locations": docs}, run)] == [0]
    broken = docs.drop("name")
    with pytest.raises(Exception):
        loads.load_entities(store, {"stg_locations": broken}, run)
    state = store.read("etl_state").collect()
    assert [(r.entity, r.last_run_status) for r in state] == [("stg_locations", "failed")]


def order_documents(spark, updated, **fields):
    """Orders as documents: {id: (update time, number of taxes)}."""
    from tradewind.sources import documents

    rows = [{"id": i, "updatedAt": u, "createdAt": u, "taxLines": [{"title": f"t{k}", "rate": 0.1} for k in range(n)]} for i, (u, n) in updated.items()]
    import json

    text = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return text.select(F.from_json("value", documents.ORDER).alias("d")).select("d.*")


def test_children_follow_after_a_load_that_failed(spark, store, monkeypatch):
    from tradewind.plans import loads as module

    run = datetime(2001, 1, 1)
    tables = ("stg_orders", "stg_order_tax_lines", "stg_order_transactions")
    first = {"gid://x/Order/1": ("2001-01-01T00:00:00Z", 2), "gid://x/Order/2": ("2001-01-02T00:00:00Z", 3)}
    second = {**first, "gid://x/Order/2": ("2001-02-01T00:00:00Z", 1), "gid://x/Order/3": ("2001-02-02T00:00:00Z", 2)}
    third = {**second, "gid://x/Order/4": ("2001-03-01T00:00:00Z", 1)}
    load = lambda docs: loads.load_orders(store, {t: order_documents(spark, docs) for t in tables}, run)
    load(first)
    with monkeypatch.context() as m:
        m.setitem(module.ORDER_FLATTENERS, "stg_order_tax_lines", lambda docs, ts: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(second)
    assert store.count("stg_orders") == 3 and store.count("stg_order_tax_lines") == 5
    state = {r.entity: r.last_run_status for r in store.read("etl_state").collect()}
    assert state["stg_order_tax_lines"] == "failed" and state["stg_orders"] == "success"
    load(third)  # the children of 2 and 3 are read again, though their orders are in
    left = {r.order_id[-1]: r["count"] for r in store.read("stg_order_tax_lines").groupBy("order_id").count().collect()}
    assert left == {"1": 2, "2": 1, "3": 2, "4": 1}
    assert loads.high_water_mark(store, "stg_order_tax_lines") == datetime(2001, 3, 1)
    assert {r.last_run_status for r in store.read("etl_state").collect()} == {"success"}


def test_order_loads_report_duplicate_keys(spark, store):
    docs = order_documents(spark, {"gid://x/Order/1": ("2001-01-01T00:00:00Z", 1)})
    loads.load_orders(store, {"stg_orders": docs.unionByName(docs)}, datetime(2001, 1, 1), "full")
    assert [r.last_run_status for r in store.read("etl_state").collect()] == ["duplicate keys"]
