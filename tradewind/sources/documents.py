"""Nested source documents: their declared shapes and the JSON-lines scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# --- fixed values: field names and nesting of the source documents -------------------
_MONEY = "struct<shopMoney: struct<amount: string, currencyCode: string>, presentmentMoney: struct<amount: string, currencyCode: string>>"
_REF = "struct<id: string>"
_ADDRESS = (
    "struct<address1: string, address2: string, city: string, province: string, provinceCode: string, "
    "countryCodeV2: string, country: string, zip: string, company: string, name: string, phone: string>"
)


def _connection(node: str) -> str:
    return f"struct<edges: array<struct<node: struct<{node}>>>, pageInfo: struct<hasNextPage: boolean>>"


_LINE = (
    "id: string, title: string, variantTitle: string, sku: string, quantity: int, currentQuantity: int, "
    "unfulfilledQuantity: int, fulfillableQuantity: int, isGiftCard: boolean, taxable: boolean, requiresShipping: boolean, "
    f"variant: struct<id: string, product: {_REF}>, originalUnitPriceSet: {_MONEY}, originalTotalSet: {_MONEY}, "
    f"totalDiscountSet: {_MONEY}, discountedTotalSet: {_MONEY}"
)
_DISCOUNT = (
    "__typename: string, allocationMethod: string, targetType: string, "
    "value: struct<__typename: string, amount: string, percentage: double>, code: string, title: string, description: string"
)
_SHIPPING = (
    "id: string, title: string, code: string, source: string, carrierIdentifier: string, "
    f"originalPriceSet: {_MONEY}, discountedPriceSet: {_MONEY}"
)
_FULFILLMENT_LINE = f"lineItem: {_REF}, quantity: int, originalTotalSet: {_MONEY}, discountedTotalSet: {_MONEY}"
_REFUND_LINE = (
    f"quantity: int, restockType: string, lineItem: {_REF}, location: {_REF}, subtotalSet: {_MONEY}, totalTaxSet: {_MONEY}"
)

ORDER = (
    "id string, name string, email string, createdAt string, processedAt string, updatedAt string, cancelledAt string, "
    "closedAt string, cancelReason string, currencyCode string, "
    f"subtotalPriceSet {_MONEY}, totalDiscountsSet {_MONEY}, totalTaxSet {_MONEY}, totalShippingPriceSet {_MONEY}, "
    f"totalPriceSet {_MONEY}, totalRefundedSet {_MONEY}, displayFinancialStatus string, displayFulfillmentStatus string, "
    f"customer {_REF}, shippingAddress {_ADDRESS}, billingAddress {_ADDRESS}, tags array<string>, note string, sourceName string, "
    f"lineItems {_connection(_LINE)}, "
    "transactions array<struct<id: string, kind: string, status: string, gateway: string, "
    f"amountSet: {_MONEY}, createdAt: string, processedAt: string, errorCode: string>>, "
    f"taxLines array<struct<title: string, rate: double, priceSet: {_MONEY}>>, "
    f"discountApplications {_connection(_DISCOUNT)}, shippingLines {_connection(_SHIPPING)}, "
    "fulfillments array<struct<id: string, status: string, displayStatus: string, totalQuantity: int, createdAt: string, "
    f"updatedAt: string, location: {_REF}, service: struct<serviceName: string>, "
    "trackingInfo: array<struct<number: string, company: string, url: string>>, "
    f"fulfillmentLineItems: {_connection(_FULFILLMENT_LINE)}>>, "
    f"refunds array<struct<id: string, createdAt: string, note: string, totalRefundedSet: {_MONEY}, "
    f"refundLineItems: {_connection(_REFUND_LINE)}>>"
)
CUSTOMER = (
    "id string, firstName string, lastName string, defaultEmailAddress struct<emailAddress: string, marketingState: string>, "
    "defaultPhoneNumber struct<phoneNumber: string, marketingState: string>, createdAt string, updatedAt string, "
    f"numberOfOrders string, amountSpent struct<amount: string>, defaultAddress {_ADDRESS}, tags array<string>, note string, "
    "taxExempt boolean"
)
PRODUCT = (
    "id string, title string, handle string, description string, productType string, vendor string, status string, "
    "createdAt string, updatedAt string, publishedAt string, tags array<string>"
)
VARIANT = (
    "id string, title string, sku string, barcode string, price string, compareAtPrice string, taxable boolean, "
    f"createdAt string, updatedAt string, product {_REF}, selectedOptions array<struct<name: string, value: string>>, "
    "inventoryItem struct<id: string, requiresShipping: boolean, unitCost: struct<amount: string>, "
    "measurement: struct<weight: struct<value: double, unit: string>>>"
)
LOCATION = (
    "id string, name string, isActive boolean, fulfillsOnlineOrders boolean, "
    "address struct<address1: string, address2: string, city: string, province: string, provinceCode: string, "
    "country: string, countryCode: string, zip: string, phone: string>"
)
INVENTORY_ITEM = (
    "id string, inventoryLevels "
    + _connection(f"updatedAt: string, location: {_REF}, quantities: array<struct<name: string, quantity: int>>")
)
CHECKOUT = (
    f"id string, createdAt string, updatedAt string, completedAt string, abandonedCheckoutUrl string, customer {_REF}, "
    f"subtotalPriceSet {_MONEY}, totalTaxSet {_MONEY}, totalPriceSet {_MONEY}, shippingAddress {_ADDRESS}, "
    f"lineItems {_connection('title: string, quantity: int')}"
)
SHAPES = {
    "order": ORDER,
    "customer": CUSTOMER,
    "product": PRODUCT,
    "variant": VARIANT,
    "location": LOCATION,
    "inventory_item": INVENTORY_ITEM,
    "checkout": CHECKOUT,
}


#: How JSON lines are kept: packed, as their field names repeat in every line, in files that each fit a task, as packed files cannot be split.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 200_000}


def read_documents(spark: SparkSession, path: str, kind: str = "order") -> DataFrame:
    """Scan JSON lines, one document per line; only the fields a query uses are parsed."""
    return spark.read.schema(SHAPES[kind]).json(path)


def as_struct(shape: str) -> StructType:
    """A declared shape as a type."""
    return StructType.fromDDL(shape)
