"""Facts kept up to date from changed orders: only the buckets of affected orders are written.

A changed order changes its own rows. It may also change the lifetime figures and the segment of its customer, which facts
repeat, and a dimension may have changed by itself. So the dimensions are built anew first and compared with what they
were, in the columns that facts take from them; every order that refers to a changed member is affected, and so are all
orders of the customers concerned, as the first order is marked. The facts of the affected orders are built by the same
functions as a full build, and replace their rows. Keys come from the registry, so all other rows keep theirs.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import id_digits
from tradewind.plans import facts as fact
from tradewind.plans.views import product_days
from tradewind.plans.warehouse import Warehouse
from tradewind.session import scratch_path
from tradewind.sources import schemas

#: The key by which facts look a dimension up, and the columns they take from it. Geographies are their own key: a
#: member changes only with the orders that have its address.
USED = {
    "dim_customer": ("customer_id", ["customer_key", "email", "full_name", "customer_segment", "lifetime_order_count"]),
    "dim_product": ("variant_id", ["product_key", "product_id", "product_title", "product_type", "vendor", "unit_cost"]),
    "dim_discount": ("discount_code", ["discount_key"]),
    "dim_location": ("location_id", ["location_key", "location_name"]),
}
REFRESHED = (*USED, "dim_geography")


class OfOrders(Mapping):
    """Staging tables with the rows of some orders (one column ``oid`` of order numbers) only."""

    _THROUGH = {"stg_fulfillment_line_items": ("fulfillment_id", "stg_fulfillments"), "stg_refund_line_items": ("refund_id", "stg_refunds")}

    def __init__(self, staging: Mapping[str, DataFrame], orders: DataFrame):
        self.staging, self.orders = staging, orders

    def __getitem__(self, table: str) -> DataFrame:
        rows = self.staging[table]
        if table in self._THROUGH:
            column, parent = self._THROUGH[table]
            return rows.join(self[parent].select(F.col("id").alias(column)), column, "left_semi")
        column = "id" if table == "stg_orders" else "order_id" if table in schemas.BUCKET_KEYS else None
        if column is None:
            return rows
        return rows.join(self.orders, id_digits(F.col(column)) == F.col("oid"), "left_semi")

    def __iter__(self) -> Iterator[str]:
        return iter(self.staging)

    def __len__(self) -> int:
        return len(self.staging)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _members(w: Warehouse, dimension: str, name: str) -> DataFrame:
    """(member, what facts take from it) of a dimension as it is stored."""
    key, used = USED[dimension]
    taken = F.struct(*[(F.col(c) > 1).alias(c) if c == "lifetime_order_count" else F.col(c) for c in used])
    rows = w.store.read(dimension).filter(F.col(key).isNotNull()).withColumn("taken", taken)
    return rows.groupBy(F.col(key).alias("member")).agg(F.min("taken").alias(name))


def refreshed(w: Warehouse, dimension: str) -> DataFrame | None:
    """Build a dimension anew; the members that are new, gone or changed in what facts take from them."""
    if dimension not in USED:
        w._build(dimension)
        return None
    before = _written(_members(w, dimension, "before"), "members")
    w._build(dimension)
    both = before.join(_members(w, dimension, "after"), "member", "full")
    changed = _written(both.filter(~F.col("before").eqNullSafe(F.col("after"))).select("member"), "changed-members")
    return None if changed.isEmpty() else changed


def affected_orders(w: Warehouse, changed: DataFrame, members: Mapping[str, DataFrame | None]) -> DataFrame:
    """(oid) of the changed orders (one column of ids), of orders that refer to changed members, and of their customers."""
    orders = w.stg["stg_orders"].select(id_digits(F.col("id")).alias("oid"), id_digits(F.col("customer_id")).alias("customer"))
    refers = {
        "dim_customer": orders.withColumnRenamed("customer", "member"),
        "dim_product": w.stg["stg_order_line_items"].select(id_digits(F.col("order_id")).alias("oid"), id_digits(F.col("variant_id")).alias("member")),
        "dim_discount": w.stg["stg_order_discount_applications"].select(id_digits(F.col("order_id")).alias("oid"), F.col("code").alias("member")),
        "dim_location": w.stg["stg_fulfillments"].select(id_digits(F.col("order_id")).alias("oid"), id_digits(F.col("location_id")).alias("member")),
    }
    found = [changed.select(id_digits(F.col(changed.columns[0])).alias("oid"))]
    found += [refers[d].join(m, "member", "left_semi").select("oid") for d, m in members.items() if m is not None]
    direct = _written(reduce(DataFrame.unionByName, found).distinct(), "affected")
    # who ordered them, now and before
    before = w.store.read("fact_order").select(F.col("order_id").alias("oid"), "customer_key").join(direct, "oid", "left_semi")
    known = w["dim_customer"].select("customer_key", F.col("customer_id").alias("customer"))
    people = orders.join(direct, "oid", "left_semi").select("customer").unionByName(before.join(known, "customer_key").select("customer"))
    theirs = orders.join(people.filter("customer is not null").distinct(), "customer", "left_semi").select("oid")
    return _written(direct.unionByName(theirs).distinct(), "affected")


def maintain(w: Warehouse, changed: DataFrame) -> DataFrame:
    """Bring dimensions and order facts up to date after ``changed`` orders (ids of new, changed or deleted ones) were staged.

    Returns the affected orders. The warehouse must number by its registry and keep its facts in buckets (``maintained``).
    """
    if not w.maintained:
        raise ValueError("open the warehouse with maintained=True")
    members = {d: refreshed(w, d) for d in REFRESHED}
    affected = affected_orders(w, changed, members)
    part = OfOrders(w.stg, affected)

    def replace(table: str, rows: DataFrame) -> None:
        w.store.replace_children(table, rows, affected)

    days = lambda: w.store.read("fact_order").join(affected.select(F.col("oid").alias("order_id")), "order_id", "left_semi").select("order_date_key")
    before = _written(days(), "days")
    replace("fact_order", fact.fact_order(part, w, w.loaded_at, w.number))
    touched = _written(before.unionByName(days()).distinct(), "days")
    orders = w.store.read("fact_order").join(affected.select(F.col("oid").alias("order_id")), "order_id", "left_semi")
    replace("fact_order_line_item", fact.fact_order_line_item(part["stg_order_line_items"], orders, w["dim_product"], w.loaded_at, w.number))
    shipped = part["stg_fulfillments"], part["stg_fulfillment_line_items"]
    replace("fact_fulfillment", fact.fact_fulfillment(*shipped, orders, w["dim_location"], w.loaded_at, w.number))
    replace("fact_refund", fact.fact_refund(part["stg_refunds"], part["stg_refund_line_items"], orders, w.loaded_at, w.number))
    if w.store.exists("agg_product_day"):
        lines = w["fact_order_line_item"].join(touched, "order_date_key", "left_semi")
        w.store.replace_children("agg_product_day", product_days(w, lines), touched)
    return affected
