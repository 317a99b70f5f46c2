"""Order children meet their orders where they lie; the wide line is shuffled once."""

import re

import pytest
from pyspark.sql import functions as F

from tradewind.plans import facts


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+)\(([^,#]+)", plan), plan


BUILDS = {
    "lines": lambda w: facts.fact_order_line_item(w.children("stg_order_line_items"), w["fact_order"], w["dim_product"], w.loaded_at),
    "fulfillments": lambda w: facts.fact_fulfillment(
        w.children("stg_fulfillments"), w.stg["stg_fulfillment_line_items"], w["fact_order"], w["dim_location"], w.loaded_at
    ),
    "refunds": lambda w: facts.fact_refund(w.children("stg_refunds"), w.stg["stg_refund_line_items"], w["fact_order"], w.loaded_at),
}


@pytest.mark.parametrize("name", BUILDS)
def test_no_exchange_on_the_order(warehouse, no_broadcast, name):
    warehouse.prepare(["fact_order", "dim_product", "dim_location"])
    found, plan = exchanges(BUILDS[name](warehouse))
    keys = [key for kind, key in found if kind == "hashpartitioning"]
    assert keys and not any(key.startswith("order_") for key in keys)
    assert "Bucketed: true" in plan


def test_the_wide_line_is_shuffled_once(warehouse, no_broadcast):
    warehouse.prepare(["fact_order", "dim_product"])
    _, plan = exchanges(BUILDS["lines"](warehouse))
    # only one shuffle moves the title of a line
    moved = 0
    for part in re.split(r"\n(?=[ :+\-]*Exchange )", plan)[1:]:
        below = part.split("\n")[1]
        moved += "title#" in below or "unit_price#" in below
    assert moved == 1


def test_semi_join_for_the_numbering_is_in_place(warehouse, no_broadcast):
    lines, orders = warehouse.children("stg_order_line_items"), warehouse["fact_order"].select(F.col("order_id").alias("order_num"))
    found, _ = exchanges(lines.select("id", "order_num").join(orders, "order_num", "left_semi"))
    assert found == []
