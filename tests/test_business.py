from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewind.operators import rules
from tradewind.plans import checks, dimensions, metrics, reports, views, vouchers


def test_warehouse_checks_hold(warehouse):
    failed = checks.verify(warehouse.stg, warehouse).filter("not ok").collect()
    assert failed == []


def test_views_answer_sql(spark, warehouse):
    names = views.register_views(spark, warehouse, warehouse.stg)
    assert len(names) == 15
    n, total = spark.sql("select count(*), sum(order_count) from v_sales_daily").first()
    assert n > 0 and total == warehouse["fact_order"].count()


def test_default_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 4018
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.day_of_week, first.day_name) == (20200101, 3, "Wednesday")


@pytest.mark.parametrize("month,quarter", [(3, 1), (5, 1), (6, 2), (12, 4), (1, 4), (2, 4)])
def test_fiscal_quarter(spark, month, quarter):
    day = F.lit(date(2024, month, 15))
    row = spark.range(1).select(dimensions.fiscal_quarter(day, 3), dimensions.fiscal_year(day, 3)).first()
    assert tuple(row) == (quarter, 2024 if month >= 3 else 2023)


def test_skewed_pivot_and_counts(spark):
    """One order holds most payments: three are laid out, all are counted."""
    from tradewind.plans.facts import order_payments

    hot = spark.range(1000).select(
        F.concat(F.lit("T"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"),
        F.lit("gid://store/Order/1").alias("order_id"),
        F.lit("SALE").alias("kind"),
        F.when(F.col("id") == 0, "FAILURE").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("g"), F.col("id")).alias("gateway"),
        F.col("id").cast("decimal(18,2)").alias("amount"),
        F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    row = order_payments(hot, 3).first()
    assert (row.total_payment_count, row.payment_1_gateway, row.payment_3_gateway) == (999, "g1", "g3")


def test_revenue_by_site(spark):
    df = spark.sql(
        "select * from values ('https://a.example.com/x', 2.0), ('https://a.example.com/y', 3.0), ('nonsense', 1.0), (null, 4.0) as t(landing_site, total_amount)"
    )
    got = {r.site: float(r.revenue) for r in metrics.revenue_by_site(df, "landing_site").collect()}
    assert got == {"a.example.com": 5.0, "(direct)": 5.0}


def test_rules(spark):
    df = spark.sql("select 'VIP,gifted' tags, 'ZA' cc, 'Cable' kind, 'PAID' financial_status, 'PARTIAL' fulfillment_status")
    row = df.select(
        *rules.tag_flags(F.col("tags")),
        *rules.tag_flags(F.col("tags"), {"whole": "GIFT"}, whole=True),
        rules.region(F.col("cc")).alias("region"),
        rules.category(F.col("kind")).alias("category"),
        *rules.status_flags(),
    ).first()
    assert (row.is_vip_order, row.is_b2b_order, row.is_gift, row.whole) == (True, False, True, False)
    assert (row.region, row.category, row.is_paid, row.is_partially_fulfilled) == ("South Africa", "Accessories", True, True)


def test_type_two_rates(spark):
    ddl = "channel_key bigint, rate_type string, rate_value decimal(8,4), effective_from date, effective_to date"
    current = spark.sql("select 1L channel_key, 'commission' rate_type, cast(0.1 as decimal(8,4)) rate_value, date'2000-01-01' effective_from, cast(null as date) effective_to")
    changes = spark.sql("select 1L channel_key, 'commission' rate_type, cast(0.2 as decimal(8,4)) rate_value, date'2001-01-01' effective_from")
    once = vouchers.apply_rate_changes(current, changes)
    assert sorted(once.collect()) == sorted(vouchers.apply_rate_changes(once, changes).collect())
    facts = spark.sql("select 1L channel_key, d from values (date'1999-01-01'), (date'2000-12-31'), (date'2001-01-01') t(d)")
    got = [str(r.rate_value) for r in vouchers.rate_in_force(facts, once, F.col("d")).orderBy("d").collect()]
    assert got == ["None", "0.1000", "0.2000"]


@pytest.mark.parametrize(
    "period,bounds",
    [
        ("this_month", (date(2001, 3, 1), date(2001, 3, 31))),
        ("last_month", (date(2001, 2, 1), date(2001, 2, 28))),
        ("this_quarter", (date(2001, 1, 1), date(2001, 3, 31))),
        ("ytd", (date(2001, 1, 1), date(2001, 12, 31))),
    ],
)
def test_periods(period, bounds):
    assert vouchers.period_bounds(period, date(2001, 3, 15)) == bounds


def test_order_comparison(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    got = {r.k: r.state for r in reports.compare_orders(left, right, "k", "v").collect()}
    assert got == {"a": "missing_right", "b": "different", "c": "missing_left"}


def test_refund_limits(warehouse):
    rows = warehouse["fact_refund"].filter("refund_percentage is not null").select(
        "refund_percentage", "is_full_refund", "is_partial_refund"
    )
    assert rows.filter("is_full_refund and is_partial_refund").isEmpty()
    assert rows.filter("refund_percentage >= 99.01 and not is_full_refund").isEmpty()


def test_scans_push_filters(warehouse):
    plan = checks.headline_orders(warehouse, date(2001, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_created_at" in plan
    assert "shipping_city" not in plan
    plan = checks.window_report(warehouse, date(2001, 8, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date_key,20010602)" in plan


def test_a_repeated_code_does_not_multiply(spark):
    from tradewind.plans.facts import one_row_per_code

    codes = spark.createDataFrame([("A", 2, 5), ("A", 1, 9), ("B", 3, 1), (None, 0, 0)], "discount_code string, discount_key int, usage_limit int")
    assert sorted(map(tuple, one_row_per_code(codes).select("discount_code", "discount_key", "usage_limit").collect())) == [("A", 1, 9), ("B", 3, 1)]


def test_backdated_rates_keep_intervals_apart(spark):
    from tradewind.plans.vouchers import apply_rate_changes

    kinds = "channel_key int, rate_type string, rate_value decimal(8,4), effective_from date"
    current = spark.createDataFrame([(1, "c", None, None)], kinds).limit(0).unionByName(
        spark.sql("select 1 channel_key, 'c' rate_type, 0.2BD rate_value, date'2000-01-01' effective_from")
    ).withColumn("effective_to", F.lit(None).cast("date"))
    changes = spark.sql(
        "select 1 channel_key, 'c' rate_type, v rate_value, d effective_from from values (0.1BD, date'1999-01-01'), (0.3BD, date'2001-01-01'), (0.25BD, date'2001-01-01') t(v, d)"
    )
    once = apply_rate_changes(current, changes)
    twice = apply_rate_changes(once, changes)
    want = [("1999-01-01", "2000-01-01", 0.1), ("2000-01-01", "2001-01-01", 0.2), ("2001-01-01", "None", 0.3)]
    for history in (once, twice):
        assert sorted((str(r.effective_from), str(r.effective_to), float(r.rate_value)) for r in history.collect()) == want


def test_growth_counts_empty_months(spark):
    from tradewind.plans.metrics import sales_growth

    orders = spark.createDataFrame([(20000105, 10), (20000310, 5)], "order_date_key int, total_amount int")
    days = spark.createDataFrame([(k,) for k in (19991231, 20000101, 20000201, 20000301, 20000401)], "date_key int")
    got = sorted((r.month, r.revenue, r.prior_revenue) for r in sales_growth({"fact_order": orders, "dim_date": days}).collect())
    assert got == [(200001, 10, None), (200002, 0, 10), (200003, 5, 0)]


def test_landing_paths_and_referring_hosts(spark):
    from tradewind.plans.metrics import revenue_by_site

    rows = [("https://a.example/products/x?y=1", 1), ("/products/x#top", 2), ("https://a.example", 4), (None, 8), ("/", 16)]
    orders = spark.createDataFrame(rows, "site string, total_amount int")
    assert {r.site: r.revenue for r in revenue_by_site(orders, "site", "PATH").collect()} == {"/products/x": 3, "(direct)": 12, "/": 16}
    assert {r.site: r.revenue for r in revenue_by_site(orders, "site", "HOST").collect()} == {"a.example": 5, "(direct)": 26}


def test_wider_pivots(monkeypatch):
    from tradewind.sources import schemas

    before = [n for n, _ in schemas.columns("fact_order")]
    assert "payment_3_amount" in before and "payment_4_amount" not in before
    monkeypatch.setattr(schemas, "PIVOT_WIDTHS", {"payments": 4, "taxes": 3, "discounts": 3})
    after = [n for n, _ in schemas.columns("fact_order")]
    assert [n for n in after if n in before] == before
    assert set(after) - set(before) == {"payment_4_gateway", "payment_4_amount", "tax_3_name", "tax_3_rate", "tax_3_amount", "discount_3_code", "discount_3_type", "discount_3_amount"}


def test_fact_order_with_wider_pivots(spark, warehouse, monkeypatch):
    from tradewind.plans.facts import fact_order
    from tradewind.sources import schemas

    warehouse["fact_order"]
    monkeypatch.setattr(schemas, "PIVOT_WIDTHS", {"payments": 4, "taxes": 3, "discounts": 3})
    built = fact_order(warehouse.stg, warehouse, F.lit(None))
    assert built.filter("payment_4_amount is not null").count() > 0 and built.filter("tax_3_amount is not null").count() > 0
