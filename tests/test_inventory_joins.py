"""Stock levels, items and products are never broadcast, however small their files look; depots may be."""

import pytest
from pyspark.sql import functions as F

from tradewind.plans import facts
from tradewind.plans.warehouse import PARTITIONS


def stored(store, table, values, names):
    """The rows as a stored table, whose files tell Spark a size."""
    store.load_full(table, store.spark.createDataFrame(values, names), partition_by=PARTITIONS.get(table), dealt=False)
    return store.read(table)


@pytest.fixture
def built(store):
    item, place = "gid://store/InventoryItem/{}", "gid://store/Location/{}"
    days = ("2001-11-30", "2001-12-31")
    levels = [(item.format(i), place.format(j), 10 * i + j, 5, day) for i in (1, 2, 3) for j in (1, 2) for day in days]
    levels.append((item.format(1), None, 7, None, days[0]))
    variants = [(f"gid://store/ProductVariant/{i}", item.format(i), "x") for i in (1, 2)]
    products = [(n, str(n), f"SKU-{n}", "2.50") for n in (1, 2)] + [(-1, None, None, None)]
    return facts.fact_inventory_snapshot(
        stored(store, "stg_inventory_levels", levels, "inventory_item_id string, location_id string, available int, on_hand int, snapshot_date string"),
        stored(store, "stg_product_variants", variants, "id string, inventory_item_id string, title string"),
        stored(store, "dim_product", products, "product_key bigint, variant_id string, sku string, unit_cost string"),
        stored(store, "dim_location", [(1, "1", "North"), (-1, None, "Unknown")], "location_key bigint, location_id string, location_name string"),
        F.current_timestamp().cast("timestamp_ntz"),
    )


def test_what_grows_with_the_shop_is_merged(built):
    plan = built._jdf.queryExecution().executedPlan().toString()
    sent = [part.split("\n")[1] for part in plan.split("BroadcastExchange")[1:]]
    assert sent and not any(name in below for below in sent for name in ("inventory_item_id#", "item_num#", "variant_id#", "sku#"))
    assert plan.count("SortMergeJoin") == 3


def test_every_level_keeps_its_row(built):
    got = {(r.inventory_item_id, r.location_id, str(r.snapshot_date)): r for r in built.collect()}
    assert len(got) == 13 and {r.inventory_snapshot_key for r in got.values()} == set(range(1, 14))
    assert got["1", "1", "2001-11-30"].sku == "SKU-1" and got["1", "1", "2001-11-30"].location_name == "North"
    assert got["3", "2", "2001-12-31"].product_key == -1 and got["1", None, "2001-11-30"].location_key == -1
    assert str(got["2", "1", "2001-12-31"].inventory_cost_value) == "12.50"
