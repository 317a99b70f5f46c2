"""Rates as of a day for a hot channel; inner lists that are longer than a table takes."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tradewind.operators import flatten as fl
from tradewind.plans import loads, vouchers
from tradewind.sources import documents

RATES = "channel_key bigint, rate_type string, rate_value decimal(8,4), effective_from date, effective_to date"


def history(spark, seed):
    rng = random.Random(seed)
    rows = []
    for channel in range(1, 8):
        day = date(1999, 1, 1) + timedelta(days=rng.randint(0, 300))
        for k in range(rng.randint(1, 9)):
            until = day + timedelta(days=rng.randint(1, 200))
            rows.append((channel, "commission", k / 10, day, None if k == 8 else until))
            day = until + timedelta(days=rng.choice([0, 0, 15]))
    return spark.createDataFrame([(c, t, None, a, b) for c, t, _, a, b in rows], RATES).withColumn(
        "rate_value", (F.col("channel_key") * 100 + F.datediff("effective_from", F.lit(date(1999, 1, 1))) / 10).cast("decimal(8,4)")
    )


def direct(df, rates):
    r = rates.select(F.col("channel_key").alias("c"), F.col("rate_value").alias("wanted"), "effective_from", "effective_to")
    inside = (F.col("d") >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col("d") < F.col("effective_to")))
    return df.join(r, (F.col("channel_key") == F.col("c")) & inside, "left").select("id", "wanted")


def test_rates_by_month_equal_the_direct_join(spark):
    rates = history(spark, 3)
    # one channel holds nine rows of ten; some days are null or before every rate
    df = spark.range(4000).selectExpr(
        "id", "if(id % 10 < 9, 1L, id % 9) as channel_key", "if(id % 97 = 0, null, date_add(date'1998-11-01', cast(id % 1500 as int))) as d"
    )
    got = {r.id: r.rate_value for r in vouchers.rate_in_force(df, rates, F.col("d")).collect()}
    assert got == {r.id: r.wanted for r in direct(df, rates).collect()} and len(got) == 4000
    assert vouchers.rate_in_force(df.limit(0), rates, F.col("d")).count() == 0


def test_a_hot_channel_spreads_over_months(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id", "if(id % 10 < 9, 1L, id % 9) as channel_key", "date_add(date'1999-01-01', cast(id as int)) as d")
        joined = vouchers.rate_in_force(df, history(spark, 3), F.col("d"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(channel_key" in plan and ", asked_month" in plan.split("hashpartitioning(channel_key")[1][:40]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    largest = df.groupBy("channel_key", F.trunc("d", "month")).count().agg(F.max("count")).first()[0]
    assert largest < 1000 / 20


def orders_with_lines(spark, sizes, cut=()):
    nodes = lambda o, n: [{"node": {"id": f"gid://x/LineItem/{o}{k:03d}", "title": "t", "quantity": 1}} for k in range(n)]
    import json

    rows = [(json.dumps({"id": f"gid://x/Order/{o}", "lineItems": {"edges": nodes(o, n), "pageInfo": {"hasNextPage": o in cut}}}),) for o, n in sizes.items()]
    return spark.createDataFrame(rows, "value string").select(F.from_json("value", documents.ORDER).alias("d")).select("d.*")


def test_long_lists_are_cut_reported_and_kept_aside(spark, store):
    docs = orders_with_lines(spark, {1: 100, 2: 101, 3: 250, 4: 0, 5: 7}, cut=(3, 5))
    result = loads.load_capped(store, "stg_order_line_items", docs, fl.flatten_line_items, datetime(2001, 1, 1))
    assert result.rows == 100 + 100 + 100 + 7
    beyond = store.read("stg_order_line_items_overflow")
    assert {r.order_id[-1]: r["count"] for r in beyond.groupBy("order_id").count().collect()} == {"2": 1, "3": 150}
    both = store.read("stg_order_line_items").unionByName(beyond)
    assert both.select("id").distinct().count() == 458
    [row] = store.read("truncated_lists").collect()
    assert (row.entity, row.list_limit, row.parents, row.rows_cut, row.cut_at_source) == ("stg_order_line_items", 100, 2, 151, 2)
    again = loads.load_capped(store, "stg_order_line_items", docs.limit(0), fl.flatten_line_items, datetime(2001, 1, 2))
    assert again.rows == 0 and store.count("stg_order_line_items_overflow") == 0
