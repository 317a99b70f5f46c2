import json
from datetime import date, datetime

from pyspark.sql import functions as F

from tradewind.functions.scalars import parse_utc
from tradewind.operators import flatten as fl
from tradewind.operators.addresses import address_key, parse_addresses
from tradewind.session import scratch_path
from tradewind.sources import documents
from tradewind.streaming.orders import stream_orders

RUN = datetime(2002, 1, 1)


def bag(value):
    return {"shopMoney": {"amount": value, "currencyCode": "ZAR"}}


FULL = {
    "id": "gid://store/Order/10",
    "name": "#10",
    "createdAt": "2001-05-01T10:00:00+02:00",
    "updatedAt": "2001-05-02T10:00:00Z",
    "cancelledAt": "not a time",
    "totalPriceSet": bag("99.50"),
    "totalRefundedSet": None,
    "customer": {"id": "gid://store/Customer/1"},
    "shippingAddress": {"city": 'The "Old" Town', "province": None, "country": "X", "zip": ""},
    "billingAddress": None,
    "tags": ["a", "b"],
    "lineItems": {
        "edges": [
            {"node": {"id": "L1", "quantity": 2, "variant": {"id": "V1", "product": {"id": "P1"}}, "originalTotalSet": bag("5")}},
            {"node": {"id": "L2", "quantity": 1, "variant": None}},
        ],
        "pageInfo": {"hasNextPage": True},
    },
    "transactions": [{"id": "T1", "amountSet": bag("oops"), "createdAt": "2001-05-01T10:00:00Z"}],
    "taxLines": [{"title": "VAT", "rate": 0.15, "priceSet": bag("1.00")}, {"title": "Levy", "rate": 0.02, "priceSet": bag("0.50")}],
    "discountApplications": {
        "edges": [
            {"node": {"__typename": "D", "code": "C", "value": {"__typename": "MoneyV2", "amount": "3.00"}}},
            {"node": {"__typename": "M", "value": {"__typename": "PricingPercentageValue", "percentage": 12.5}}},
        ]
    },
    "fulfillments": [
        {
            "id": "F1",
            "trackingInfo": [{"number": "n1"}, {"number": "n2"}],
            "fulfillmentLineItems": {"edges": [{"node": {"lineItem": {"id": "L1"}, "quantity": 2}}]},
        },
        {"id": "F2", "trackingInfo": []},
    ],
    "refunds": [{"id": "R1", "refundLineItems": {"edges": [{"node": {"quantity": 1, "lineItem": {"id": "L1"}}}]}}],
}
BARE = {"id": "gid://store/Order/11", "updatedAt": "2001-05-03T00:00:00Z", "tags": []}


def docs(spark, *items, kind="order", label="docs"):
    path = scratch_path(spark, label)
    lines = spark.createDataFrame([(json.dumps(item),) for item in items], "value string")
    lines.coalesce(1).write.text(path)
    return documents.read_documents(spark, path, kind), path


def test_order_header(spark):
    frame, _ = docs(spark, FULL, BARE)
    full, bare = fl.flatten_orders(frame, RUN).orderBy("id").collect()
    assert full.created_at == datetime(2001, 5, 1, 8) and full.cancelled_at is None
    assert str(full.total_price) == "99.50" and full.total_refunded is None
    assert full.tags == "a,b" and bare.tags is None
    assert full.billing_address_json is None and bare.customer_id is None
    assert full.landing_site is None and full.extracted_at == RUN


def test_children(spark):
    frame, _ = docs(spark, FULL, BARE)
    count = {name: f(frame, RUN).collect() for name, f in fl.ORDER_FLATTENERS.items()}
    lines = {r.id: r for r in count["stg_order_line_items"]}
    assert lines["L1"].product_id == "P1" and lines["L2"].variant_id is None
    assert count["stg_order_transactions"][0].amount is None
    assert [r.line_number for r in count["stg_order_tax_lines"]] == [1, 2]
    money, percent = sorted(count["stg_order_discount_applications"], key=lambda r: r.line_number)
    assert money.value_percentage is None and str(percent.value_percentage) == "12.50" and percent.value_amount is None
    shipped = {r.id: r.tracking_number for r in count["stg_fulfillments"]}
    assert shipped == {"F1": "n1", "F2": None}
    assert [r.line_item_id for r in count["stg_fulfillment_line_items"]] == ["L1"]
    assert len(count["stg_refunds"]) == len(count["stg_refund_line_items"]) == 1
    assert count["stg_order_shipping_lines"] == []
    assert fl.oversized(frame, "lineItems", 100).first()[0] == 1
    assert str(frame.filter("name is not null").select(fl.sum_amounts(F.col("taxLines"), "priceSet")).first()[0]) == "1.50"


def test_other_entities(spark):
    levels = {
        "id": "I1",
        "inventoryLevels": {
            "edges": [{"node": {"location": {"id": "L"}, "quantities": [{"name": "available", "quantity": 4}, {"name": "new", "quantity": 9}]}}]
        },
    }
    frame, _ = docs(spark, levels, kind="inventory_item")
    row = fl.flatten_inventory_levels(frame, RUN, date(2001, 1, 1)).first()
    assert (row.available, row.on_hand, row.snapshot_date) == (4, None, date(2001, 1, 1))
    frame, _ = docs(spark, {"id": "C1", "numberOfOrders": "many"}, {"id": "C2", "numberOfOrders": "3"}, kind="customer")
    assert [r.number_of_orders for r in fl.flatten_customers(frame, RUN).orderBy("id").collect()] == [None, 3]
    frame, _ = docs(spark, {"id": "V1", "selectedOptions": [{"name": "Size", "value": "L"}]}, kind="variant")
    row = fl.flatten_variants(frame, RUN).first()
    assert (row.option1, row.option2) == ("L", None)
    frame, _ = docs(spark, {"id": "X1", "lineItems": {"edges": []}}, kind="checkout")
    row = fl.flatten_abandoned_checkouts(frame, RUN).first()
    assert (row.line_items_count, row.line_items_json, row.email) == (0, None, None)


def test_address_parts(spark):
    df = spark.createDataFrame([('{"city": "A \\"b\\" c", "country": "", "zip": "1"}',), (None,)], "text string")
    quoted, missing = parse_addresses(df, "text").select("city", "country", address_key().alias("k")).collect()
    assert (quoted.city, quoted.country, quoted.k) == ('A "b" c', None, 'a "b" c|||1')
    assert missing.k == "|||"


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Africa/Johannesburg")
        df = spark.createDataFrame([("2024-01-15T10:30:00Z",), ("2024-01-15T10:30:00",), ("bad",)], "t string")
        got = [r[0] for r in df.select(parse_utc(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [datetime(2024, 1, 15, 10, 30)] * 2 + [None]


def test_stream_of_documents(spark, store):
    _, path = docs(spark, FULL, BARE, {**FULL, "updatedAt": "2001-06-01T00:00:00Z", "note": "newer"}, label="stream")
    tables = ("stg_orders", "stg_order_line_items")
    for _ in range(2):  # the second run reads the same files with a new checkpoint
        stream_orders(spark, path, store, scratch_path(spark, "stream-state"), tables).awaitTermination()
    orders = {r.id[-2:]: r for r in store.read("stg_orders").collect()}
    assert set(orders) == {"10", "11"} and orders["10"].note == "newer"
    assert store.count("stg_order_line_items") == 2
