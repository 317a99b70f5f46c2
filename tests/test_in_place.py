"""Wide rows stay in the buckets of their order number while staged tables and facts are built; each bucket is one file."""

import re

import pytest
from test_packed import shuffled

from tradewind.plans import warehouse as wh
from tradewind.sources import adapter

WIDE = {
    "fact_order": r"\b(_base|landing_site)#",
    "fact_order_line_item": r"\b(title|unit_price)#",
    "fact_fulfillment": r"\btracking_url#",
    "fact_refund": r"\btotal_refunded#",
}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("parts", ["4", "40"])
@pytest.mark.parametrize("table", WIDE)
def test_no_wide_row_moves(warehouse, spark, no_broadcast, table, parts):
    warehouse[table]
    before = spark.conf.get(wh.WIDTH)
    spark.conf.set(wh.WIDTH, parts)
    try:
        with wh.joined_in_place(spark, warehouse.store.buckets):
            moved = shuffled(wh.BUILDS[table](warehouse))
        assert spark.conf.get(wh.WIDTH) == parts and spark.conf.get(wh.ALL_KEYS) == "true"
    finally:
        spark.conf.set(wh.WIDTH, before)
    assert moved and not any(re.search(WIDE[table], columns) for columns, _ in moved)
    assert len(warehouse[table].inputFiles()) <= warehouse.store.buckets


@pytest.mark.parametrize("table, moves", [("stg_orders", 4), ("stg_fulfillments", 2), ("stg_refunds", 2)])
def test_staged_rows_are_dealt_once(warehouse, spark, no_broadcast, table, moves):
    buckets = warehouse.store.buckets
    with wh.joined_in_place(spark, buckets):
        made = shuffled(adapter.BUILDERS[table](warehouse.base, lambda rows, order: rows.repartition(buckets, order)))
    known = [columns for columns, _ in made if not re.search(r"\b[nr]_", columns) or "o_orderkey" in columns]
    assert len([c for c in known if "c_custkey" not in c or "o_orderkey" in c]) <= moves


def test_settings_come_back_after_the_last_of_two_builds(spark):
    before = spark.conf.get(wh.WIDTH)
    with wh.joined_in_place(spark, 9):
        with wh.joined_in_place(spark, 9):
            assert spark.conf.get(wh.WIDTH) == "9"
        assert spark.conf.get(wh.WIDTH) == "9" and spark.conf.get(wh.ALL_KEYS) == "false"
    assert spark.conf.get(wh.WIDTH) == before and spark.conf.get(wh.ALL_KEYS) == "true"


def sorted_again(df):
    """The sorts of a plan that take what a join gives, with no shuffle between."""
    tree = df._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [[line for line in tree[i + 1 :] if "Project [" not in line][0] for i, line in enumerate(tree) if " Sort [" in line]
    return [line for line in below if "Join" in line]


@pytest.mark.parametrize("table", ["fact_order_line_item", "fact_fulfillment", "fact_refund"])
def test_wide_rows_are_sorted_once(warehouse, spark, no_broadcast, table):
    warehouse[table]
    with wh.joined_in_place(spark, warehouse.store.buckets):
        assert not sorted_again(wh.BUILDS[table](warehouse))
