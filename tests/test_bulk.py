"""Bulk exports: routing by type, children without a parent, places, a hot parent, lines that are not JSON."""

import json

from pyspark.sql import functions as F

from tradewind.operators import flatten as fl
from tradewind.sources import bulk

ORDER, FULFILLMENT = "gid://x/Order/{}", "gid://x/Fulfillment/{}"


def export(spark, tmp_path, rows, files=1):
    path = str(tmp_path / "bulk")
    text = spark.createDataFrame([(k, r if isinstance(r, str) else json.dumps(r)) for k, r in enumerate(rows)], "k int, value string")
    text.repartitionByRange(files, "k").sortWithinPartitions("k").select("value").write.text(path)
    return bulk.read_lines(spark, path)


def line(n, order):
    return {"id": f"gid://x/LineItem/{n}", "quantity": n, "__parentId": ORDER.format(order)}


def test_children_find_their_parents_at_both_levels(spark, tmp_path):
    rows = [
        {"id": ORDER.format(1), "fulfillments": [{"id": FULFILLMENT.format(7)}, {"id": FULFILLMENT.format(8)}]},
        line(1, 1), line(2, 99), {"id": ORDER.format(2)}, line(3, 2), "not json", "", {"id": "gid://x/Other/3"},
        {"quantity": 4, "lineItem": {"id": "a"}, "__parentId": FULFILLMENT.format(8)}, {"quantity": 5, "__parentId": FULFILLMENT.format(80)},
        {"id": "gid://x/ShippingLine/5", "title": "s", "__parentId": ORDER.format(2)},
    ]
    lines = export(spark, tmp_path, rows)
    pages = bulk.pages(lines)
    stamp = F.lit(None).cast("timestamp_ntz")
    got = {r.id[-1]: r.order_id[-1] for r in fl.flatten_line_items(pages["lines"], stamp).collect()}
    assert got == {"1": "1", "3": "2"}
    assert [(r.fulfillment_id, r.quantity) for r in fl.flatten_fulfillment_line_items(pages["fulfillment_lines"], stamp).collect()] == [(FULFILLMENT.format(8), 4)]
    assert [r.title for r in fl.flatten_shipping_lines(pages["shipping"], stamp).collect()] == ["s"]
    assert fl.flatten_orders(pages["orders"], stamp).count() == 2
    assert sorted((r.page, r.parent[-2:], r.lines) for r in bulk.orphans(lines).collect()) == [("fulfillment_lines", "80", 1), ("lines", "99", 1)]


def test_discounts_are_numbered_in_the_order_of_the_export(spark, tmp_path):
    rows = [{"id": ORDER.format(o)} for o in (1, 2)]
    rows += [{"__typename": "T", "code": f"c{k:04d}", "__parentId": ORDER.format(1 + k % 2)} for k in range(600)]
    pages = bulk.pages(export(spark, tmp_path, rows, files=3))
    got = fl.flatten_discount_applications(pages["discounts"], F.lit(None).cast("timestamp_ntz")).collect()
    assert {(r.order_id[-1], r.line_number): r.code for r in got} == {(str(1 + k % 2), k // 2 + 1): f"c{k:04d}" for k in range(600)}


def test_empty_export(spark, tmp_path):
    lines = export(spark, tmp_path, [""])
    assert all(df.count() == 0 for df in bulk.pages(lines).values()) and bulk.orphans(lines).count() == 0


def test_orphans_are_found_in_one_reading(spark, tmp_path):
    rows = [{"id": ORDER.format(1), "fulfillments": [{"id": FULFILLMENT.format(7)}], "refunds": [{"id": "gid://x/Refund/7"}]}, {"id": ORDER.format(2), "refunds": None}]
    rows += [line(n, 3 + n % 2) for n in range(5)] + [line(9, 1)]
    rows += [{"code": "c", "__parentId": ORDER.format(3)}, {"id": "gid://x/ShippingLine/1", "__parentId": ORDER.format(2)}]
    rows += [{"quantity": 1, "__parentId": f"gid://x/Refund/{n}"} for n in (7, 8, 8)] + [{"quantity": 1, "__parentId": FULFILLMENT.format(7)}]
    lost = bulk.orphans(export(spark, tmp_path, rows, files=3))
    assert lost._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    found = {("lines", ORDER.format(3), 3), ("lines", ORDER.format(4), 2), ("discounts", ORDER.format(3), 1), ("refund_lines", "gid://x/Refund/8", 2)}
    assert {(r.page, r.parent, r.lines) for r in lost.collect()} == found
