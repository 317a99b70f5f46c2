"""Operators driven by lists of rules instead of fixed columns."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import flag
from tradewind.sources.tables import TableStore


@dataclass(frozen=True)
class Match:
    """A named rule: any of the texts (ignoring case), a code pattern, or a type."""

    name: str
    texts: tuple[str, ...] = ()
    pattern: str | None = None
    kind: str | None = None


# --- fixed values: the default rule sets ------------------------------------------------
PAYMENTS = ("card_payments", "gift_card", "paypal", "manual")
TAXES = (Match("vat", ("VAT",)), Match("levy", ("Levy", "Environmental Levy")))
DISCOUNTS = (
    Match("voucher", pattern="^[A-Z0-9]{15,16}$"),
    Match("promotion", pattern="^PROMO.*"),
    Match("staff", pattern="^STAFF.*"),
    Match("manual", kind="ManualDiscountApplication"),
)
CARRIERS = (
    Match("standard", ("standard", "default")),
    Match("express", ("express", "overnight")),
    Match("collect", ("collect", "pickup")),
)
SEGMENTS = (
    ("New", "lifetime_order_count = 1 AND days_since_first_order <= 30"),
    ("Active", "days_since_last_order <= 90"),
    ("At Risk", "days_since_last_order BETWEEN 91 AND 180"),
    ("Lapsed", "days_since_last_order > 180"),
)
ORDER_TAGS = {"is_vip_order": "VIP", "is_b2b_order": "B2B", "is_gift": "GIFT"}
CUSTOMER_TAGS = {"is_wholesale": "wholesale", "is_vip": "VIP"}
REGIONS = {"South Africa": ("ZA",), "Africa (Other)": ("NA", "BW", "ZW", "MZ"), "International": ("*",)}
OPTIONS = {"option1": "size", "option2": "color", "option3": "material"}
CATEGORIES = {
    "Accessories": ("Phone Case", "Screen Protector", "Cable"),
    "Audio": ("Headphones", "Earbuds", "Speakers"),
}
STATUSES = {
    "is_paid": ("financial_status", ("PAID", "PARTIALLY_REFUNDED")),
    "is_fully_refunded": ("financial_status", ("REFUNDED",)),
    "is_fulfilled": ("fulfillment_status", ("FULFILLED",)),
    "is_partially_fulfilled": ("fulfillment_status", ("PARTIAL", "IN_PROGRESS")),
}


def any_text(c: Column, texts: Sequence[str]) -> Column:
    """One of the texts occurs in ``c``, ignoring case; ``%`` and ``_`` are literal."""
    found = F.lit(False)
    for text in texts:
        found = found | F.lower(c).contains(text.lower())
    return flag(found)


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


# --- pivots named by rules ----------------------------------------------------------------
def payment_pivot(transactions: DataFrame, gateways: Sequence[str] = PAYMENTS) -> DataFrame:
    return (
        transactions.filter((F.col("kind") == "SALE") & (F.col("status") == "SUCCESS"))
        .groupBy("order_id")
        .agg(
            *[_sum_if(F.col("gateway") == g, F.col("amount")).alias(f"payment_{g}_amount") for g in gateways],
            F.count(F.lit(1)).alias("payment_method_count"),
        )
    )


def tax_pivot(tax_lines: DataFrame, rules: Sequence[Match] = TAXES) -> DataFrame:
    cells = []
    for rule in rules:
        hit = any_text(F.col("title"), rule.texts)
        cells += [
            F.max(F.when(hit, F.col("rate"))).alias(f"tax_{rule.name}_rate"),
            _sum_if(hit, F.col("price")).alias(f"tax_{rule.name}_amount"),
        ]
    return tax_lines.groupBy("order_id").agg(*cells)


def discount_pivot(applications: DataFrame, rules: Sequence[Match] = DISCOUNTS) -> DataFrame:
    value = F.coalesce("value_amount", "value_percentage")
    cells = []
    for rule in rules:
        hit = F.lit(False)
        if rule.pattern:
            hit = hit | F.col("code").rlike(rule.pattern)
        if rule.kind:
            hit = hit | (F.col("discount_type") == rule.kind)
        hit = flag(hit)
        cells += [
            F.max(F.when(hit, F.col("code"))).alias(f"discount_{rule.name}_code"),
            _sum_if(hit, value).alias(f"discount_{rule.name}_amount"),
        ]
    return applications.groupBy("order_id").agg(*cells)


def carrier_pivot(shipping_lines: DataFrame, rules: Sequence[Match] = CARRIERS) -> DataFrame:
    cells = []
    for rule in rules:
        hit = any_text(F.col("carrier_identifier"), rule.texts)
        cells += [
            F.max(F.when(hit, F.col("title"))).alias(f"shipping_{rule.name}_method"),
            _sum_if(hit, F.col("discounted_price")).alias(f"shipping_{rule.name}_amount"),
        ]
    return shipping_lines.groupBy("order_id").agg(*cells)


# --- columns from rules -----------------------------------------------------------------
def segment(rules: Sequence[tuple[str, str]] = SEGMENTS, default: str = "Unknown") -> Column:
    """Label of the first predicate that holds."""
    out = F.lit(default)
    for label, predicate in reversed(rules):
        out = F.when(F.expr(predicate), label).otherwise(out)
    return out


def tag_flags(tags: Column, rules: Mapping[str, str] = ORDER_TAGS, whole: bool = False) -> list[Column]:
    """A flag per tag: the text occurs anywhere, or with ``whole`` equals one listed tag."""

    def hit(tag: str) -> Column:
        if whole:
            return flag(F.array_contains(F.split(tags, ","), tag))
        return any_text(tags, [tag])

    return [hit(tag).alias(name) for name, tag in rules.items()]


def region(country_code: Column, rules: Mapping[str, Sequence[str]] = REGIONS) -> Column:
    """Region of a country; the region that lists ``*`` takes the rest."""
    out = F.lit(next((name for name, codes in rules.items() if "*" in codes), None)).cast("string")
    for name, codes in rules.items():
        if "*" not in codes:
            out = F.when(country_code.isin(*codes), name).otherwise(out)
    return out


def category(product_type: Column, rules: Mapping[str, Sequence[str]] = CATEGORIES, default: str = "Other") -> Column:
    out = F.lit(default)
    for name, kinds in rules.items():
        out = F.when(product_type.isin(*kinds), name).otherwise(out)
    return out


def option_aliases(df: DataFrame, names: Mapping[str, str] = OPTIONS) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def status_flags(rules: Mapping[str, tuple[str, Sequence[str]]] = STATUSES) -> list[Column]:
    return [flag(F.col(column).isin(*values)).alias(name) for name, (column, values) in rules.items()]


# --- fixed values: the retention policy -----------------------------------------
STAGING_DAYS, FACT_MONTHS, SOFT_DELETE = 7, 60, True


def retention_limit(as_of: date, days: int | None = None, months: int | None = None) -> date:
    """The first day that is kept; a month that has no such day gives its last one."""
    if days is not None:
        return as_of - timedelta(days=days)
    year, month = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    return date(year, month + 1, min(as_of.day, monthrange(year, month + 1)[1]))


def apply_retention(store: TableStore, table: str, as_of: date, days: int | None = None, months: int | None = None, soft: bool = SOFT_DELETE) -> list[str]:
    """Remove (or retire) the partitions that lie wholly before the window; returns their values.

    Partitions are days (2001-12-31) or months (200112). What is left of the oldest partition is for ``within_retention``.
    """
    limit = retention_limit(as_of, days, months)
    first = {10: limit.isoformat(), 6: f"{limit.year}{limit.month:02d}"}
    return store.retain(table, lambda value: value < first[len(value)], soft)


def within_retention(df: DataFrame, column: str, as_of: date, days: int | None = None, months: int | None = None) -> DataFrame:
    """Rows young enough to keep. On a partition column the rest is never read."""
    limit = F.lit(as_of)
    limit = F.date_sub(limit, days) if days is not None else F.add_months(limit, -months)
    return df.filter(F.col(column) >= limit)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values in use, to start a rule list from."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()
