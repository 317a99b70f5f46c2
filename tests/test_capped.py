"""Capped lists are written where they are read and dealt by a later upsert only."""

from datetime import datetime

from pyspark.sql import functions as F

from tradewind.operators import flatten as fl
from tradewind.plans import loads
from tradewind.sources import documents


def test_capped_lists_are_not_dealt(spark, store):
    line = "named_struct('id', 'a', 'quantity', 1)"
    rows = spark.sql(f"select 'gid://x/Order/1' as id, named_struct('edges', array(named_struct('node', {line})), 'pageInfo', named_struct('hasNextPage', false)) as lineItems")
    rows = rows.select("id", F.from_json(F.to_json("lineItems"), documents.as_struct(documents.ORDER)["lineItems"].dataType).alias("lineItems"))
    loads.load_capped(store, "stg_order_line_items", rows, fl.flatten_line_items, datetime(2001, 1, 1), 1)
    assert store.partition_of("stg_order_line_items") is None and store.count("stg_order_line_items") == 1
    store.upsert("stg_order_line_items", store.read("stg_order_line_items").withColumn("quantity", F.lit(2)))
    assert [r.quantity for r in store.read("stg_order_line_items").collect()] == [2]
