"""Facts maintained from changed orders equal a rebuild; few buckets are written; keys stay."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators.row_index import row_index
from tradewind.plans.keys import KeyRegistry
from tradewind.plans.maintain import maintain
from tradewind.plans.warehouse import TEST_AS_OF, TEST_CALENDAR, Warehouse
from tradewind.session import scratch_path
from tradewind.sources import schemas
from tradewind.sources.tables import TableStore

FACTS = ("fact_order", "fact_order_line_item", "fact_fulfillment", "fact_refund", "agg_product_day")
TABLES = [t for t in schemas.STAGING]


def rows_of(w):
    return {t: sorted(map(repr, w.store.read(t).drop("loaded_at").collect())) for t in FACTS}


def files_of(w):
    return {t: set(w.store.spark.table(w.store.name(t)).inputFiles()) for t in FACTS}


def order_number(column="order_id"):
    return F.regexp_extract(column, "[0-9]+$", 0).cast("bigint")


@pytest.fixture(scope="module")
def staged(spark, warehouse):
    """Staging of the orders whose number leaves no 5 when divided by 11, and of all orders; written once."""
    whole = {t: warehouse.stg[t] for t in TABLES}
    early = dict(whole)
    for t in TABLES:
        if t in schemas.BUCKET_KEYS:
            early[t] = whole[t].filter(order_number() % 11 != 5)
    early["stg_orders"] = whole["stg_orders"].filter(order_number("id") % 11 != 5)
    early["stg_products"] = whole["stg_products"].filter(order_number("id") % 50 != 7)
    return early, whole


@pytest.fixture(scope="module")
def maintained(spark, warehouse, staged):
    staging = dict(staged[0])
    store = TableStore(spark, scratch_path(spark, "maintained"), buckets=16)
    w = Warehouse(spark, staging, store, TEST_AS_OF, TEST_CALENDAR, maintained=True)
    w.prepare(["dim_date", "dim_customer", "dim_product", "dim_geography", "dim_discount", "dim_location", *FACTS])
    return w


def test_new_orders_and_products_equal_a_rebuild(spark, maintained, staged):
    before = {r.order_id: r.order_key for r in maintained.store.read("fact_order").collect()}
    maintained.stg.update(staged[1])
    new = staged[1]["stg_orders"].filter(order_number("id") % 11 == 5).select("id")
    maintain(maintained, new)
    got = rows_of(maintained)
    after = {r.order_id: r.order_key for r in maintained.store.read("fact_order").collect()}
    assert len(after) > len(before) and all(after[i] == k for i, k in before.items())
    for table in ("dim_customer", "dim_product", "dim_geography", "dim_discount", "dim_location", *FACTS):
        maintained._build(table)
    assert got == rows_of(maintained)


def test_one_changed_order_writes_few_buckets(spark, maintained, staged):
    orders = staged[1]["stg_orders"]
    guest = orders.filter("customer_id is null").orderBy("id").first()["id"]
    changed = F.col("id") == guest
    maintained.stg["stg_orders"] = orders.withColumn("note", F.when(changed, "changed").otherwise(F.col("note")))
    taxes = staged[1]["stg_order_tax_lines"]
    maintained.stg["stg_order_tax_lines"] = taxes.filter(F.col("order_id") != guest)  # its taxes are gone
    files = files_of(maintained)
    affected = maintain(maintained, spark.createDataFrame([(guest,)], "id string"))
    assert affected.count() == 1
    assert all(len(files[t] - now) <= len(files[t]) / 8 for t, now in files_of(maintained).items())
    row = maintained.store.read("fact_order").filter(F.col("notes") == "changed").collect()
    assert len(row) == 1 and row[0].tax_1_name is None
    got = rows_of(maintained)
    for table in FACTS:
        maintained._build(table)
    assert got == rows_of(maintained)


def test_registered_keys_stay(spark, store):
    number = KeyRegistry(store).number
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    keys = lambda df: {r.id: r.n for r in df.collect()}
    first = keys(number(frame("b", "d", "c"), ["id"], "n"))
    assert first == {r.id: r.n for r in row_index(frame("b", "d", "c"), [F.col("id")], "n").collect()}
    again = keys(number(frame("a", "b", "c", "e"), ["id"], "n"))
    assert again == {"b": 1, "c": 2, "a": 4, "e": 5}
    assert keys(number(frame("d"), ["id"], "n")) == {"d": 3}
