"""Voucher and channel layer on top of the warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.scalars import (
    count_if,
    date_key,
    days_between,
    flag,
    id_digits,
    null_if_empty,
    percent_of,
    ratio,
    spread_of,
    zero,
)
from tradewind.operators.relational import align, first_rows, spread_nulls, with_member
from tradewind.operators.row_index import row_index

Tables = Mapping[str, DataFrame]

# --- fixed values -------------------------------------------------------------
GIFT_CARD, DISCOUNT_CODE = "gift_card", "discount_code"
SMS, DIRECT = "sms", "direct_channel"
REFUND, IN_PROCESS, MARKETING = "Refund", "In Process", "Marketing"
SUBSCRIPTION_PREFIX = "Subscription "


# --- dimensions -----------------------------------------------------------------
def dim_channel(channels: DataFrame, loaded_at: Column) -> DataFrame:
    keyed = row_index(channels.select("channel_id"), [F.col("channel_id")], "channel_key")
    return with_member(
        align(channels.join(keyed, "channel_id").drop("contact_name", "contact_email", "extracted_at"), "dim_channel"),
        "dim_channel",
        channel_key=0,
        channel_name="Unknown Channel",
    ).withColumn("loaded_at", loaded_at)


def subscription_percent(campaign: Column) -> Column:
    found = null_if_empty(F.regexp_extract(campaign, r"([0-9]+)%", 1))
    return F.when(campaign.startswith(SUBSCRIPTION_PREFIX), found.cast("decimal(5,2)"))


def subscription_months(campaign: Column) -> Column:
    found = null_if_empty(F.regexp_extract(campaign, r"([0-9]+) Month", 1))
    return F.when(campaign.startswith(SUBSCRIPTION_PREFIX), found.cast("int"))


def normalise_segments(segments: DataFrame) -> DataFrame:
    """Bring both ways of recording a refund into one shape.

    Either the client column says Refund and the campaign holds the client's name, or
    the campaign says Refund and the client column holds the reason. Pending refunds
    (campaign In Process) have no client.
    """
    client, campaign = F.col("client"), F.col("campaign")
    swapped = flag((client == REFUND) & (campaign != IN_PROCESS))
    pending = flag((client == REFUND) & (campaign == IN_PROCESS))
    reasoned = flag((campaign == REFUND) & (client != REFUND))
    return segments.select(
        "segment_id",
        "code",
        F.when(swapped, REFUND).otherwise(campaign).alias("campaign"),
        F.when(swapped, campaign).when(pending | reasoned, None).otherwise(client).alias("client"),
        F.when(reasoned, F.coalesce("refund_reason", client)).otherwise(F.col("refund_reason")).alias("refund_reason"),
        (swapped | pending | reasoned).alias("is_refund"),
    )


def discount_redemptions(stg: Tables) -> DataFrame:
    """Orders on which a discount voucher was used, matched by its code."""
    codes = stg["stg_voucher_inventory"].filter(F.col("voucher_type") == DISCOUNT_CODE).select("voucher_code")
    used = stg["stg_order_discount_applications"].filter(F.col("code").isNotNull())
    orders = stg["stg_orders"].select(F.col("id").alias("order_id"), "created_at", "subtotal_price", "total_price")
    share = F.round(F.col("subtotal_price") * F.col("value_percentage") / 100, 2)
    return (
        used.join(codes, used["code"] == codes["voucher_code"])
        .join(orders, "order_id")
        .select(
            "voucher_code",
            id_digits(F.col("order_id")).alias("redemption_order_id"),
            F.col("created_at").alias("redemption_date"),
            F.coalesce("value_amount", share).cast("decimal(18,2)").alias("redeemed_amount"),
            "total_price",
        )
    )


def card_matches(stg: Tables) -> DataFrame:
    """Gift-card vouchers matched by store id; the last four characters must agree."""
    vouchers = stg["stg_voucher_inventory"].filter(F.col("voucher_type") == GIFT_CARD).select(
        "voucher_code", "channel_id", F.col("store_object_id").alias("id")
    )
    cards = stg["stg_gift_cards"]
    return (
        vouchers.filter("id is not null")
        .join(cards, "id")
        .filter(F.right("voucher_code", F.lit(4)) == F.col("code"))
        .select(
            "voucher_code",
            "channel_id",
            "id",
            "initial_value",
            "balance",
            "expires_on",
            "order_id",
            (F.col("initial_value") - F.col("balance")).cast("decimal(18,2)").alias("redeemed_amount"),
        )
    )


def card_redemptions(stg: Tables) -> DataFrame:
    """A gift card whose balance fell was used, on the order recorded with it."""
    orders = stg["stg_orders"].select(F.col("id").alias("order_id"), F.col("created_at").alias("redemption_date"))
    used = card_matches(stg).filter(F.col("balance") < F.col("initial_value"))
    used = used.withColumn("order_id", spread_nulls(F.col("order_id"), F.col("voucher_code")))
    return used.join(orders, "order_id", "left").select(
        "voucher_code",
        F.when(~F.col("order_id").startswith("~"), id_digits(F.col("order_id"))).alias("redemption_order_id"),
        "redemption_date",
        "redeemed_amount",
    )


def dim_voucher(stg: Tables, dwh: Tables, loaded_at: Column) -> DataFrame:
    vouchers = stg["stg_voucher_inventory"]
    sent = first_rows(
        stg["stg_voucher_distributions"], ["voucher_id"], [F.col("distribution_date"), F.col("distribution_id")], 1
    ).select("voucher_id", "distribution_date", "distribution_method", "subscription_flag", "subscription_month")
    redeemed = first_rows(
        discount_redemptions(stg).drop("total_price").unionByName(card_redemptions(stg)),
        ["voucher_code"],
        [F.col("redemption_date").asc_nulls_last(), F.col("redemption_order_id")],
        1,
    ).select("voucher_code", "redemption_order_id", "redemption_date", "redeemed_amount", F.lit(True).alias("used"))
    campaigns = first_rows(normalise_segments(stg["stg_campaign_segments"]), ["code"], [F.col("segment_id")], 1).select(
        F.col("code").alias("voucher_code"), F.col("campaign").alias("campaign_name"), "client"
    )
    expiries = card_matches(stg).select("voucher_code", F.col("expires_on").alias("card_expires_on"))
    discounts = (
        vouchers.filter(F.col("voucher_type") == DISCOUNT_CODE)
        .select("voucher_code", id_digits(F.col("store_object_id")).alias("discount_id"))
        .join(dwh["dim_discount"].select("discount_id", "discount_key", "ends_at"), "discount_id")
        .select("voucher_code", "discount_key", "ends_at")
    )
    channels = dwh["dim_channel"].filter("channel_id is not null").select(
        F.col("channel_id").alias("chan"), "channel_key", "channel_name"
    )
    keyed = row_index(vouchers.select("voucher_code"), [F.col("voucher_code")], "voucher_key")
    full = vouchers.join(sent, "voucher_id", "left").join(keyed, "voucher_code")
    for part in (redeemed, campaigns, expiries, discounts):
        full = full.join(part, "voucher_code", "left")
    full = full.withColumn("chan", spread_nulls(F.col("channel_id"), F.col("voucher_code"))).join(
        channels, "chan", "left"
    )
    built = full.select(
        "voucher_key",
        "voucher_code",
        "voucher_type",
        zero(F.col("channel_key")).alias("channel_key"),
        "campaign_name",
        subscription_percent(F.col("campaign_name")).alias("subscription_discount_pct"),
        subscription_months(F.col("campaign_name")).alias("subscription_term_months"),
        flag(F.col("client") == MARKETING).alias("is_marketing"),
        "face_value",
        "currency_code",
        "status",
        "batch_id",
        "created_in_store_at",
        F.col("discount_key").alias("store_discount_key"),
        F.col("distribution_date").isNotNull().alias("is_distributed"),
        "distribution_date",
        "distribution_method",
        flag(F.col("subscription_flag")).alias("is_subscription"),
        "subscription_month",
        flag(F.col("used")).alias("is_redeemed"),
        "redemption_date",
        "redemption_order_id",
        "redeemed_amount",
        F.coalesce("card_expires_on", "ends_at").alias("expires_on"),
        days_between(F.col("distribution_date"), F.col("created_in_store_at")).alias("days_in_inventory"),
        days_between(F.col("redemption_date"), F.col("distribution_date")).alias("days_to_redemption"),
        F.coalesce("channel_name", F.lit("Unknown Channel")).alias("channel_name"),
    )
    return with_member(align(built, "dim_voucher"), "dim_voucher", voucher_key=0, channel_key=0).withColumn(
        "loaded_at", loaded_at
    )


# --- commission rates (type-2 history) --------------------------------------------
def ref_commission_rate(rates: DataFrame, dim_channel: DataFrame, loaded_at: Column) -> DataFrame:
    keyed = rates.join(dim_channel.select("channel_id", "channel_key"), "channel_id").drop("channel_id")
    order = [F.col("channel_key"), F.col("rate_type"), F.col("effective_from")]
    return align(row_index(keyed, order, "commission_rate_key").withColumn("loaded_at", loaded_at), "ref_commission_rate")


def apply_rate_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Type-2 update: the history of every rate rebuilt from its rows and the changes.

    ``changes`` holds channel_key, rate_type, rate_value and effective_from; of two for one rate and day the higher value
    stands. A change may lie before rows that exist. A value that only repeats the one before it adds no row,
    so re-runs are safe; each row ends where the next begins, or where it ended before if that is earlier.
    """
    keys = ["channel_key", "rate_type"]
    old = current.select(*keys, "rate_value", "effective_from", F.col("effective_to").alias("until"), F.lit(0).alias("new"))
    new = changes.select(*keys, "rate_value", "effective_from", F.lit(None).cast("date").alias("until"), F.lit(1).alias("new"))
    starts = (
        old.unionByName(new)
        .groupBy(*keys, "effective_from")
        .agg(F.max_by(F.struct("rate_value", "until"), F.struct("new", "rate_value")).alias("r"))
        .select(*keys, "effective_from", "r.rate_value", "r.until")
    )
    order = W.partitionBy(*keys).orderBy("effective_from")
    told = starts.withColumn("before", F.lag("rate_value").over(order)).filter("before is null or before <> rate_value")
    ends = F.least("until", F.lead("effective_from").over(order))
    return told.select(*keys, "rate_value", "effective_from", ends.alias("effective_to"))


def rate_in_force(df: DataFrame, rates: DataFrame, day: Column, rate_type: str = "commission") -> DataFrame:
    """Join the rate valid on ``day``: equal channel, day within [from, to).

    Every interval of a rate is laid out over the months it touches, and rows meet it by channel and month before the days are
    compared. So the rows of one channel spread over its months, and no row meets the whole history of its channel. Open
    intervals end with the latest day asked for.
    """
    asked = df.withColumn("asked_day", day).withColumn("asked_month", F.trunc("asked_day", "month"))
    latest = asked.agg(F.max("asked_day")).scalar()
    last_day = F.least(F.date_sub(F.col("effective_to"), 1), latest)  # least leaves out nulls
    of_type = rates.filter(F.col("rate_type") == rate_type).withColumn("last_day", last_day).filter("effective_from <= last_day")
    months = F.sequence(F.trunc("effective_from", "month"), F.trunc("last_day", "month"), F.expr("interval 1 month"))
    binned = of_type.select(F.col("channel_key").alias("rate_channel"), "rate_value", "effective_from", "last_day", F.explode(months).alias("rate_month"))
    met = (F.col("channel_key") == F.col("rate_channel")) & (F.col("asked_month") == F.col("rate_month"))
    inside = (F.col("asked_day") >= F.col("effective_from")) & (F.col("asked_day") <= F.col("last_day"))
    return asked.join(binned, met & inside, "left").drop(
        "rate_channel", "rate_month", "effective_from", "last_day", "asked_day", "asked_month"
    )


# --- facts ------------------------------------------------------------------------
def dual_redemption_orders(stg: Tables) -> DataFrame:
    """Orders paid by gift card that also carry a discount application."""
    by_card = stg["stg_order_transactions"].filter(F.col("gateway") == GIFT_CARD).select("order_id").distinct()
    return by_card.join(
        stg["stg_order_discount_applications"].select("order_id").distinct(), "order_id", "left_semi"
    ).select(id_digits(F.col("order_id")).alias("redemption_order_id"))


def lifecycle_status(redeemed: Column, expired: Column, distributed: Column) -> Column:
    return (
        F.when(redeemed, "redeemed").when(expired, "expired").when(distributed, "distributed").otherwise("created")
    )


def fact_voucher_lifecycle(stg: Tables, dwh: Tables, as_of: date, loaded_at: Column) -> DataFrame:
    vouchers = dwh["dim_voucher"].filter("voucher_key > 0").withColumn(
        "spent_on", spread_nulls(F.col("redemption_order_id"), F.col("voucher_code"))
    )
    orders = dwh["fact_order"].select(
        F.col("order_id").alias("spent_on"), F.col("total_amount").alias("order_total"), "order_number"
    )
    first_product = (
        dwh["fact_order_line_item"]
        .groupBy(F.col("order_id").alias("spent_on"))
        .agg(F.min_by("product_key", "line_item_id").alias("product_key"))
    )
    dual = dual_redemption_orders(stg).select(
        F.col("redemption_order_id").alias("spent_on"), F.lit(True).alias("dual")
    )
    full = vouchers
    for part in (orders, first_product, dual):
        full = full.join(part, "spent_on", "left")
    redeemed = F.col("is_redeemed")
    expired = flag(~redeemed & (F.col("expires_on") < F.lit(as_of)))
    face, used = F.col("face_value"), F.col("redeemed_amount")
    made = F.col("created_in_store_at")
    built = full.select(
        # One row per voucher code in code order, so the voucher's number serves here too.
        F.col("voucher_key").alias("voucher_lifecycle_key"),
        "voucher_key",
        "channel_key",
        date_key(made).alias("creation_date_key"),
        date_key(F.col("distribution_date")).alias("distribution_date_key"),
        date_key(F.col("redemption_date")).alias("redemption_date_key"),
        F.when(expired, date_key(F.col("expires_on"))).alias("expiry_date_key"),
        F.when(redeemed, F.col("product_key")).alias("product_key"),
        "voucher_code",
        "voucher_type",
        "batch_id",
        lifecycle_status(redeemed, expired, F.col("is_distributed")).alias("lifecycle_status"),
        "is_distributed",
        "is_redeemed",
        expired.alias("is_expired"),
        flag(F.col("dual")).alias("is_dual_redemption"),
        "face_value",
        F.col("order_total").alias("redemption_order_total"),
        used.alias("redemption_discount_amount"),
        F.when(redeemed, F.col("order_total") - used).alias("overspend"),
        F.when(expired, face).when(redeemed, face - used).alias("breakage_amount"),
        days_between(F.col("distribution_date"), made).alias("days_creation_to_distribution"),
        days_between(F.col("redemption_date"), F.col("distribution_date")).alias("days_distribution_to_redemption"),
        days_between(F.col("redemption_date"), made).alias("days_creation_to_redemption"),
        "is_subscription",
        "subscription_month",
        "distribution_method",
        "channel_name",
        F.col("order_number").alias("redemption_order_number"),
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_voucher_lifecycle")


def channel_day_counts(lifecycle: DataFrame) -> DataFrame:
    """Each voucher counted on its creation, distribution, redemption and expiry day."""
    roles = F.filter(
        F.array(
            *[
                F.struct(F.lit(role).alias("role"), F.col(f"{column}_date_key").alias("date_key"))
                for role, column in (
                    ("created", "creation"),
                    ("distributed", "distribution"),
                    ("redeemed", "redemption"),
                    ("expired", "expiry"),
                )
            ]
        ),
        lambda entry: entry["date_key"].isNotNull(),
    )
    stacked = lifecycle.withColumn("event", F.explode(roles)).select("*", "event.role", "event.date_key")

    def on(role: str, value: Column) -> Column:
        return F.sum(F.when(F.col("role") == role, value).otherwise(0))

    face = F.col("face_value")
    return stacked.groupBy("channel_key", "date_key").agg(
        *[on(role, F.lit(1)).alias(f"vouchers_{role}") for role in ("created", "distributed", "redeemed", "expired")],
        *[on(role, face).alias(f"face_value_{role}") for role in ("created", "distributed", "redeemed")],
        on("redeemed", zero(F.col("redemption_order_total"))).alias("redemption_order_revenue"),
        on("redeemed", zero(F.col("overspend"))).alias("overspend_total"),
        on("expired", zero(F.col("breakage_amount"))).alias("breakage_total"),
    )


def _day_of(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def fact_channel_daily(lifecycle: DataFrame, dim_channel: DataFrame, loaded_at: Column) -> DataFrame:
    """Every day of a channel from its first activity to the last day of any channel."""
    counts = channel_day_counts(lifecycle)
    last_day = counts.agg(F.max("date_key")).scalar()
    days = (
        counts.groupBy("channel_key")
        .agg(F.min("date_key").alias("first_key"))
        .withColumn("day", F.explode(F.sequence(_day_of(F.col("first_key")), _day_of(last_day))))
        .select("channel_key", date_key(F.col("day")).alias("date_key"))
    )
    # One channel's days are bounded by the calendar, so the running window is too.
    so_far = W.partitionBy("channel_key").orderBy("date_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = days.join(counts, ["channel_key", "date_key"], "left").na.fill(0)
    for role in ("created", "distributed", "redeemed"):
        running = running.withColumn(f"cumulative_{role}", F.sum(f"vouchers_{role}").over(so_far))
    named = running.join(
        dim_channel.select("channel_key", "channel_name"), "channel_key", "left"
    )
    made, sent, used = (F.col(f"cumulative_{role}") for role in ("created", "distributed", "redeemed"))
    built = named.select(
        "*",
        (sent - used).alias("outstanding_distributed"),
        percent_of(sent, made).cast("decimal(8,2)").alias("distribution_rate"),
        percent_of(used, sent).cast("decimal(8,2)").alias("redemption_rate"),
    )
    numbered = row_index(built, [F.col("channel_key"), F.col("date_key")], "channel_daily_key")
    return align(numbered.withColumn("loaded_at", loaded_at), "fact_channel_daily")


# --- views and reports over the layer ----------------------------------------------
def order_payment_split(stg: Tables, dwh: Tables) -> DataFrame:
    """Gift card, discount and cash share of each order, with its first voucher."""
    by_card = F.col("gateway") == GIFT_CARD
    tender = (
        stg["stg_order_transactions"]
        .filter((F.col("kind") == "SALE") & (F.col("status") == "SUCCESS"))
        .groupBy(id_digits(F.col("order_id")).alias("order_id"))
        .agg(
            F.sum(F.when(by_card, F.col("amount")).otherwise(0)).alias("gc"),
            F.sum(F.when(~by_card, F.col("amount")).otherwise(0)).alias("cash"),
        )
    )
    voucher = (
        dwh["dim_voucher"]
        .filter("redemption_order_id is not null")
        .groupBy(F.col("redemption_order_id").alias("order_id"))
        .agg(F.min(F.struct("voucher_key", "voucher_code", "channel_key", "channel_name")).alias("v"))
    )
    gc, discount = zero(F.col("gc")), zero(F.col("discount_amount"))
    return (
        dwh["fact_order"]
        .select("order_id", "order_key", "order_number", "order_date_key", "customer_key", "discount_amount", "total_amount")
        .join(tender, "order_id", "left")
        .join(voucher, "order_id", "left")
        .select(
            "order_key",
            "order_number",
            "order_date_key",
            "customer_key",
            gc.alias("gc_amount"),
            discount.alias("discount_amount"),
            zero(F.col("cash")).alias("cash_amount"),
            "total_amount",
            (gc > 0).alias("has_gift_card"),
            (discount > 0).alias("has_discount_code"),
            ((gc > 0) & (discount > 0)).alias("is_dual_redemption"),
            "v.voucher_code",
            "v.voucher_key",
            "v.channel_key",
            "v.channel_name",
        )
    )


def channel_metrics(lifecycle: DataFrame, distributions: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """The voucher metrics of each channel: funnel, money, timing, subscription, delivery."""
    sent, used = F.col("is_distributed"), F.col("is_redeemed")
    face, subscription = F.col("face_value"), F.col("is_subscription")
    totals = lifecycle.groupBy("channel_key").agg(
        F.count(F.lit(1)).alias("vouchers_created"),
        count_if(sent).alias("vouchers_distributed"),
        count_if(used).alias("vouchers_redeemed"),
        count_if(F.col("is_expired")).alias("vouchers_expired"),
        F.sum(F.when(sent, face).otherwise(0)).alias("face_value_distributed"),
        F.sum(F.when(used, face).otherwise(0)).alias("face_value_redeemed"),
        F.sum(zero(F.col("redemption_order_total"))).alias("redemption_order_revenue"),
        F.sum(zero(F.col("overspend"))).alias("overspend_total"),
        F.sum(zero(F.col("breakage_amount"))).alias("breakage_total"),
        *[
            part
            for name in ("creation_to_distribution", "distribution_to_redemption", "creation_to_redemption")
            for part in spread_of(F.col(f"days_{name}"), name)
        ],
        count_if(subscription).alias("subscription_vouchers"),
        count_if(subscription & used).alias("subscription_redeemed"),
        count_if(subscription & sent).alias("subscription_distributed"),
        F.max("subscription_month").alias("subscription_tenure"),
        count_if(F.col("distribution_method") == SMS).alias("sms_count"),
        count_if(F.col("distribution_method") == DIRECT).alias("direct_count"),
    )
    delivery = (
        distributions.filter(F.col("distribution_method") == SMS)
        .groupBy("channel_id")
        .agg(F.count(F.lit(1)).alias("sms_sent"), count_if(F.col("sms_status") == "delivered").alias("sms_delivered"))
    )
    channels = dim_channel.select("channel_key", "channel_id", "channel_name").join(delivery, "channel_id", "left")
    outstanding = F.col("vouchers_distributed") - F.col("vouchers_redeemed")
    return totals.join(channels, "channel_key").select(
        "channel_name",
        "vouchers_created",
        "vouchers_distributed",
        "vouchers_redeemed",
        "vouchers_expired",
        ratio(F.col("vouchers_distributed"), F.col("vouchers_created"), 100).alias("distribution_rate"),
        ratio(F.col("vouchers_redeemed"), F.col("vouchers_distributed"), 100).alias("redemption_rate"),
        outstanding.alias("outstanding_vouchers"),
        "face_value_distributed",
        "face_value_redeemed",
        "redemption_order_revenue",
        "overspend_total",
        ratio(F.col("overspend_total"), F.col("face_value_redeemed"), 100).alias("upsell_rate"),
        (outstanding * ratio(F.col("face_value_distributed"), F.col("vouchers_distributed"))).alias("outstanding_liability"),
        "breakage_total",
        ratio(F.col("creation_to_distribution_sum"), F.col("creation_to_distribution_n")).alias("avg_days_in_inventory"),
        ratio(F.col("distribution_to_redemption_sum"), F.col("distribution_to_redemption_n")).alias("avg_days_to_redeem"),
        ratio(F.col("creation_to_redemption_sum"), F.col("creation_to_redemption_n")).alias("avg_total_lifecycle"),
        "subscription_vouchers",
        ratio(F.col("subscription_redeemed"), F.col("subscription_distributed"), 100).alias("subscription_redemption_rate"),
        "subscription_tenure",
        "sms_count",
        "direct_count",
        ratio(F.col("sms_delivered"), F.col("sms_sent"), 100).alias("sms_delivery_rate"),
    )


def provisional_billing(lifecycle: DataFrame, rates: DataFrame) -> DataFrame:
    """Commission owed per channel and the margin left after it.

    Vouchers are summed per channel and day first; the rate history then joins a few
    thousand rows instead of every voucher.
    """
    daily = lifecycle.groupBy("channel_key", "channel_name", "creation_date_key").agg(
        F.count(F.lit(1)).alias("quantity"),
        count_if(F.col("is_redeemed")).alias("redeemed"),
        F.sum("face_value").alias("face_value"),
        F.sum(zero(F.col("redemption_order_total"))).alias("revenue"),
    )
    rated = rate_in_force(daily, rates, _day_of(F.col("creation_date_key")))
    billing = F.sum(F.col("face_value") * F.col("rate_value"))
    totals = rated.groupBy("channel_name").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("redeemed").alias("redeemed_vouchers"),
        F.sum("face_value").alias("voucher_base"),
        F.sum("revenue").alias("sales_revenue"),
        F.coalesce(billing, F.lit(0)).cast("decimal(28,4)").alias("provisional_billing"),
    )
    return totals.select(
        "*",
        ratio(F.col("redeemed_vouchers"), F.col("quantity"), 100).alias("redemption_rate"),
        (F.col("sales_revenue") - F.col("provisional_billing")).alias("margin"),
    )


def redemption_anomalies(daily: DataFrame, low: float = 0.5, high: float = 2.0, days: int = 7) -> DataFrame:
    """Days whose redemptions fall far below or above the average of the days before."""
    before = W.partitionBy("channel_key").orderBy("date_key").rowsBetween(-days, -1)
    usual = F.sum("vouchers_redeemed").over(before).cast("double") / F.count("vouchers_redeemed").over(before)
    rated = daily.select("channel_name", "date_key", "vouchers_redeemed", usual.alias("avg_before")).withColumn(
        "ratio", F.col("vouchers_redeemed").cast("double") / F.nullif(F.col("avg_before"), F.lit(0.0))
    )
    return rated.filter((F.col("ratio") < low) | (F.col("ratio") > high))


def period_bounds(period: str, as_of: date) -> tuple[date, date]:
    """First and last day of a named period around ``as_of``."""
    month_start = as_of.replace(day=1)
    if period == "this_month":
        return month_start, _month_end(month_start)
    if period == "last_month":
        end = month_start - timedelta(days=1)
        return end.replace(day=1), end
    if period == "this_quarter":
        start = month_start.replace(month=3 * ((as_of.month - 1) // 3) + 1)
        return start, _month_end(start.replace(month=start.month + 2))
    if period == "ytd":
        return as_of.replace(month=1, day=1), as_of.replace(month=12, day=31)
    raise ValueError(f"unknown period {period!r}")


def _month_end(day: date) -> date:
    following = (day.replace(day=28) + timedelta(days=4)).replace(day=1)
    return following - timedelta(days=1)


def channel_summary(daily: DataFrame, period: str, as_of: date, channel: str | None = None) -> DataFrame:
    """Totals of a period per channel; outstanding is the balance on its last day."""
    first, last = (int(day.strftime("%Y%m%d")) for day in period_bounds(period, as_of))
    rows = channel_rows(daily, channel).filter(F.col("date_key").between(first, last))
    totals = rows.groupBy("channel_name").agg(
        F.sum("vouchers_distributed").alias("distributed"),
        F.sum("vouchers_redeemed").alias("redeemed"),
        F.sum("face_value_redeemed").alias("face_value_redeemed"),
        F.sum("overspend_total").alias("overspend"),
        F.sum("redemption_order_revenue").alias("revenue"),
        F.max_by("outstanding_distributed", "date_key").alias("outstanding"),
    )
    return totals.withColumn("redemption_pct", ratio(F.col("redeemed"), F.col("distributed"), 100))


def channel_rows(df: DataFrame, channel: str | None) -> DataFrame:
    """What a channel's manager may see: only that channel's rows."""
    return df if channel is None else df.filter(F.col("channel_name") == channel)


def outstanding_liability(daily: DataFrame) -> DataFrame:
    """Vouchers still out on the latest day, valued at the channel's average face value."""
    average = daily.groupBy("channel_name").agg(
        F.sum("face_value_distributed").alias("face"), F.sum("vouchers_distributed").alias("sent")
    )
    latest = daily.filter(F.col("date_key") == daily.agg(F.max("date_key")).scalar())
    return latest.join(average, "channel_name").select(
        "channel_name",
        F.col("outstanding_distributed").alias("outstanding_vouchers"),
        (F.col("outstanding_distributed") * ratio(F.col("face"), F.col("sent"))).alias("estimated_liability"),
    )
