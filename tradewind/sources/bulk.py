"""Bulk exports: JSON lines of mixed types, where the entries of a connection are lines of their own that name their parent.

A line's type follows from its id and from the type of its parent. Lists that the export leaves nested (payments, taxes,
fulfilments, refunds) stay in the order's line; lines, discounts and shipping lines point to an order, and the entries of a
fulfilment or refund point to an element of a list inside an order's line. Every child becomes a document with one entry, so the
flatteners of nested documents read both forms, and no list is ever put together again.

Children whose parent is not in the export are left out and told apart by ``orphans``. Lines that are not JSON, or of no
known type, are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.sources import documents

# --- fixed values: page -> (type of the parent, type of the child by its id, connection, list inside the order) -----
CHILDREN = {
    "lines": ("Order", "LineItem", "lineItems", None),
    "discounts": ("Order", None, "discountApplications", None),
    "shipping": ("Order", "ShippingLine", "shippingLines", None),
    "fulfillment_lines": ("Fulfillment", None, "fulfillmentLineItems", "fulfillments"),
    "refund_lines": ("Refund", None, "refundLineItems", "refunds"),
}
PARENT = "__parentId"


def _type_of(gid: Column) -> Column:
    return F.regexp_extract(gid, "^gid://[^/]+/([A-Za-z]+)/", 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, id, parent, kind, parent_kind, file, block, row): the lines of an export and where they stand."""
    text = spark.read.text(path)
    keys = text.select(
        "value", F.json_tuple("value", "id", PARENT).alias("id", "parent"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )
    return keys.withColumns({"kind": F.coalesce(_type_of(F.col("id")), F.lit("")), "parent_kind": _type_of(F.col("parent"))})


def _entry_schema(connection: str, inside: str | None) -> str:
    """The declared type of a connection's entries."""
    from pyspark.sql.types import ArrayType

    field = documents.as_struct(documents.ORDER)[inside or connection].dataType
    if inside:
        assert isinstance(field, ArrayType)
        field = field.elementType[connection].dataType
    return field["edges"].dataType.elementType["node"].dataType.simpleString()


def _orders(lines: DataFrame) -> DataFrame:
    """The orders' own lines."""
    return lines.filter(F.col("parent").isNull() & (F.col("kind") == "Order"))


def order_documents(lines: DataFrame) -> DataFrame:
    """The orders' own lines as documents; their connections are absent."""
    return _orders(lines).select(F.from_json("value", documents.as_struct(documents.ORDER)).alias("d")).select("d.*")


def _ids(inside: str) -> Column:
    """The ids in a list of an order's line."""
    return F.from_json("value", f"{inside} array<struct<id: string>>")[inside]["id"]


def parents(lines: DataFrame, inside: str | None) -> DataFrame:
    """(parent) ids that children may point to: orders, or elements of a list inside them."""
    return _orders(lines).select((F.col("id") if inside is None else F.explode(_ids(inside))).alias("parent"))


def _is_child(page: str) -> Column:
    parent_kind, kind, _, _ = CHILDREN[page]
    return (F.col("parent_kind") == parent_kind) & (F.col("kind") == (kind or ""))


def _children(lines: DataFrame, page: str) -> DataFrame:
    return lines.filter(_is_child(page))


def child_documents(lines: DataFrame, page: str) -> DataFrame:
    """One document for each child line of a page: (id, connection) or (list of one parent with the connection), and its place.

    Discounts have no id; their place among those of their order, in the order of the export, numbers them.
    """
    _, _, connection, inside = CHILDREN[page]
    # The text is parsed before the join, so that typed entries are shuffled and no text.
    node = F.from_json("value", _entry_schema(connection, inside)).alias("node")
    known = _children(lines, page).select("parent", "file", "block", "row", node).join(parents(lines, inside).distinct(), "parent", "left_semi")
    place = F.row_number().over(W.partitionBy("parent").orderBy("file", "block", "row")) if page == "discounts" else F.lit(1)
    edges = F.struct(F.array(F.struct("node")).alias("edges"), F.struct(F.lit(False).alias("hasNextPage")).alias("pageInfo"))
    if inside:
        return known.select(F.array(F.struct(F.col("parent").alias("id"), edges.alias(connection))).alias(inside))
    return known.select(F.col("parent").alias("id"), edges.alias(connection), place.alias("place"))


def orphans(lines: DataFrame) -> DataFrame:
    """(page, parent, lines): children whose parent is not in the export.

    The export is read once: an order's line names what may be pointed to, a child's line what it points to, and both meet by it.
    """
    lists = sorted({inside for *_, inside in CHILDREN.values() if inside})

    def named(place: str, page: str | None = None) -> Callable[[Column], Column]:
        return lambda parent: F.struct(F.lit(place).alias("place"), parent.alias("parent"), F.lit(page).cast("string").alias("page"))

    held = [F.transform(F.coalesce(_ids(inside), F.array().cast("array<string>")), named(inside)) for inside in lists]
    says = F.when(F.col("parent").isNull() & (F.col("kind") == "Order"), F.concat(F.array(named("orders")(F.col("id"))), *held))
    for page, (_, _, _, inside) in CHILDREN.items():
        says = says.when(_is_child(page), F.array(named(inside or "orders", page)(F.col("parent"))))
    said = lines.select(F.explode(says).alias("e")).select("e.*").filter(F.col("parent").isNotNull())
    counts = {page: F.count_if(F.col("page") == page).alias(page) for page in CHILDREN}
    lost = said.groupBy("place", "parent").agg(F.count_if(F.col("page").isNull()).alias("held"), *counts.values()).filter(F.col("held") == 0)
    per_page = F.array(*[F.struct(F.lit(page).alias("page"), F.col(page).alias("lines")) for page in CHILDREN])
    return lost.select("parent", F.explode(per_page).alias("c")).select("c.page", "parent", "c.lines").filter(F.col("lines") > 0)


def pages(lines: DataFrame) -> dict[str, DataFrame]:
    """Documents of every page of an export: ``orders`` and the pages of ``CHILDREN``."""
    return {"orders": order_documents(lines), **{page: child_documents(lines, page) for page in CHILDREN}}
